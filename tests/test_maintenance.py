"""Differences of builds, compaction, retention, profiles and clustered files."""

import glob
import random
import shutil
from collections import Counter
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import fixture
from starkit.operators.checks import CheckFailed
from starkit.operators.profiles import described, drift, merged, profile, profile_parts
from starkit.plans import layout, maintenance
from starkit.plans.builds import published
from starkit.plans.clustered import interleaved, range_bounds, range_number, write_clustered
from starkit.plans.incremental import incremental_build, lost_rows
from starkit.plans.maintenance import bag_diff, build_diff, compact, fact_diff, keyed_diff, retain
from starkit.plans.model import BuildConfig, load_model
from workload import features


def rows(df):
    return Counter(tuple(map(str, r)) for r in df.collect())


def add_feed(spark, folder, name, feed):
    df = spark.createDataFrame(feed, fixture.FEED_SCHEMA).coalesce(1)
    df.select("*", *[F.lit("").alias(c) for c in fixture.EXTRA_COLUMNS]).write.parquet(str(folder / "feed" / name))


DAYS = fixture.FEED[:2], fixture.FEED[2:5], fixture.FEED[5:]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """The configuration and folder of a model of three daily builds, which no test changes."""
    folder = tmp_path_factory.mktemp("daily")
    (folder / "whole").mkdir()
    paths = fixture.write_fixture(spark, folder / "whole")
    config = BuildConfig(
        **{**paths, "feed_path": str(folder / "feed/*/*.parquet")},
        target=str(folder / "model"), export_maps=False, cube=True,
    )
    for day, feed in enumerate(DAYS):
        add_feed(spark, folder, f"day-{day}", feed)
        incremental_build(spark, config)
    return config, folder


@pytest.fixture
def daily(built, tmp_path):
    """The same with a copy of the model, and feed files and labels of its own."""
    config, folder = built
    shutil.copytree(folder / "model", tmp_path / "model")
    shutil.copytree(folder / "whole", tmp_path / "whole")
    paths = {"demographics_path": str(tmp_path / "whole/cities.csv"), "labels_path": str(tmp_path / "whole/labels.sas")}
    assert folder.parent == tmp_path.parent
    feeds = f"{folder.parent}/{{{folder.name},{tmp_path.name}}}/feed/*/*.parquet"
    return replace(config, target=str(tmp_path / "model"), feed_path=feeds, **paths), tmp_path


def contents(spark, config, cube=True):
    found = {view: rows(df) for view, df in load_model(spark, config.target, cube).items() if "cube" not in view}
    feed = spark.read.parquet(config.feed_path)
    return found, rows(lost_rows(spark, config.target, feed))


def folders(config):
    return {path.rstrip("/").rsplit("/", 1)[1] for path in glob.glob(f"{config.target}/*/")}


# Compaction and retention --------------------------------------------------------


def test_compaction_keeps_rows_ids_and_readers(spark, daily):
    config, folder = daily
    before, reader = contents(spark, config), load_model(spark, config.target)["fact_immigration"]
    old = published(spark, config.target)[0]
    entry = compact(spark, config.target)
    assert len(old.fact_parts) > 1 and len(entry.fact_parts) == len(entry.reject_parts) == 1
    assert contents(spark, config) == before
    assert rows(reader) == before[0]["fact_immigration"]  # the old files are still there
    assert compact(spark, config.target) == entry
    # The next day adds to the compacted model.
    add_feed(spark, folder, "day-3", fixture.FEED)
    tables, _ = incremental_build(spark, config)
    ids = [r["id"] for r in tables["fact_immigration"].select("id").collect()]
    assert len(set(ids)) == len(ids) == 2 * len(fixture.FACT)
    counted = load_model(spark, config.target, cube=True)["cube_immigration"]
    assert counted.filter("grouping_set = 'origins'").agg(F.sum("visits")).first()[0] == len(ids)


@pytest.mark.parametrize("step", ["write_counted", "publish"])
def test_an_interrupted_compaction_changes_nothing(spark, daily, monkeypatch, step):
    config, _ = daily
    before = contents(spark, config)
    with monkeypatch.context() as patch:
        patch.setattr(maintenance, step, lambda *_, **__: (_ for _ in ()).throw(OSError("disk full")))
        with pytest.raises(OSError):
            compact(spark, config.target)
    assert contents(spark, config) == before
    compact(spark, config.target)
    assert contents(spark, config) == before


def test_retention_deletes_what_no_kept_build_needs(spark, daily):
    config, _ = daily
    before = contents(spark, config)
    names = [entry.build for entry in reversed(published(spark, config.target))]
    # The last build's fact has parts in all three folders.
    assert retain(spark, config.target, keep=1, grace_seconds=0).deleted == ()
    compact(spark, config.target)
    orphan = f"{layout.BUILD_PREFIX}left-by-a-failure"
    spark.range(3).write.parquet(f"{config.target}/{orphan}/x.parquet")
    spark.range(3).write.parquet(f"{config.target}/notes")
    assert retain(spark, config.target, keep=1, grace_seconds=3600).deleted == ()  # too young
    assert folders(config) >= {*names, orphan}
    found = retain(spark, config.target, keep=1, grace_seconds=0)
    assert set(found.deleted) == {names[0], names[1], orphan}
    assert [entry.kind for entry in found.kept] == ["compacted"]
    assert "notes" in folders(config) and contents(spark, config) == before
    assert retain(spark, config.target, keep=1, grace_seconds=0).deleted == ()
    with pytest.raises(ValueError):
        retain(spark, config.target, keep=0)
    with pytest.raises(CheckFailed):
        retain(spark, config.target + "-none")


def test_an_interrupted_retention_is_finished_later(spark, daily, monkeypatch):
    config, folder = daily
    compact(spark, config.target)
    before = contents(spark, config)
    real, calls = maintenance._last_change, []

    def fails_later(files, status):
        calls.append(1)
        if len(calls) > 1:
            raise OSError("store is away")
        return real(files, status)

    with monkeypatch.context() as patch:
        patch.setattr(maintenance, "_last_change", fails_later)
        with pytest.raises(OSError):
            retain(spark, config.target, keep=1, grace_seconds=0)
    assert contents(spark, config) == before
    assert len(retain(spark, config.target, keep=1, grace_seconds=0).deleted) == 1
    add_feed(spark, folder, "day-3", fixture.FEED)
    incremental_build(spark, config)


# Differences -----------------------------------------------------------------------


def test_keyed_differences(spark):
    schema = "k string, n int, a string, b double"
    before = spark.createDataFrame([("x", 1, "p", 1.0), ("x", None, "q", None), ("y", 1, "r", 2.0), ("z", 1, "s", 0.0)], schema)
    after = spark.createDataFrame([("x", 1, "p", 1.0), ("x", None, "q", 5.0), ("z", 1, None, 3.0), (None, 1, "n", 1.0)], schema)
    found = keyed_diff(before, after.select("b", "k", "a", "n"), ("k", "n"))
    assert {tuple(r)[:3]: r["columns"] for r in found.collect()} == {
        ("x", None, "changed"): ["b"],
        ("y", 1, "removed"): [],
        ("z", 1, "changed"): ["a", "b"],
        (None, 1, "added"): [],
    }
    assert keyed_diff(before, before, ("k", "n")).count() == 0
    assert keyed_diff(before, after, ("k", "n"), ("a", "b")).filter("change = 'changed'").count() == 0
    with pytest.raises(CheckFailed, match="columns differ"):
        keyed_diff(before, after.drop("a"), ("k", "n"))


def test_bag_differences(spark):
    before = spark.createDataFrame([(1, "a")] * 3 + [(2, None)] * 2 + [(3, "c")], "x int, y string")
    after = spark.createDataFrame([(1, "a")] * 5 + [(2, None)] * 2 + [(4, "d")], "x int, y string")
    assert rows(bag_diff(before, after)) == Counter([("1", "a", "2"), ("3", "c", "-1"), ("4", "d", "1")])


def test_differences_of_builds(spark, daily):
    config, folder = daily
    numbers = sorted(entry.number for entry in published(spark, config.target))
    found = build_diff(spark, config.target, numbers[0], numbers[1])
    named = {(r["table_name"], r["row_key"]): (r["change"], r["columns"]) for r in found.collect()}
    assert named[("dim_arrival_location", "LOS|CA")] == ("added", [])
    assert named[("dim_arrival_date", "20546")] == ("added", [])
    assert {change for change, _ in named.values()} == {"added"}
    assert build_diff(spark, config.target, numbers[2], numbers[2]).count() == 0
    with pytest.raises(CheckFailed, match="no build"):
        build_diff(spark, config.target, numbers[0], 99)
    surplus = fact_diff(spark, config.target, numbers[1], numbers[2])
    assert {(r["arrival_location_port_code"], r["arrival_date_id"], r["surplus"]) for r in surplus.collect()} == {("NYC", 20547, 1)}
    # A label and a city statistic change; the place has its id still.
    labels = folder / "whole" / "labels.sas"
    labels.write_text(fixture.LABELS.replace("LOS ANGELES, CA", "LOS ANGELOS, CA").replace("'JAPAN'", "'NIPPON'"))
    incremental_build(spark, config)
    found = build_diff(spark, config.target, numbers[2], max(e.number for e in published(spark, config.target)))
    named = {(r["table_name"], r["row_key"]): (r["change"], r["columns"]) for r in found.collect()}
    assert named[("dim_arrival_location", "LOS|CA")] == ("changed", ["port_name"])
    assert named[("dim_origin_country", "209")] == ("changed", ["country_name"])
    assert {key[1].split("|")[0] for key, (change, _) in named.items() if change == "removed"} == {"LOS"}


# Profiles --------------------------------------------------------------------------


def measured(seed, count):
    rnd = random.Random(seed)
    return [(rnd.randint(-5, 5 * count), rnd.choice(["a", "bb", None]), rnd.random() if rnd.random() > 0.1 else float("nan"), k % 2 == 0) for k in range(count)]


def test_profiles_merge(spark):
    schema = "n int, s string, d double, b boolean"
    parts = [spark.createDataFrame(measured(k, 300 * (k + 1)), schema) for k in range(3)]
    whole = parts[0].union(parts[1]).union(parts[2])
    exact = ["column_name", "row_count", "null_count", "least", "greatest", "length_total"]
    united = profile(parts[0], "t").union(profile(parts[1], "t")).union(profile(parts[2], "t"))
    once, together = profile(whole, "t"), merged(united)
    assert rows(once.select(*exact)) == rows(together.select(*exact))
    for found in (described(once, (0.0, 0.5, 1.0)), described(together, (0.0, 0.5, 1.0))):
        n = found.filter("column_name = 'n'").first()
        values = sorted(r["n"] for r in whole.select("n").collect())
        assert abs(n["distinct_estimate"] - len(set(values))) <= 0.05 * len(set(values))
        low, middle, high = n["quantiles"]
        assert (low, high) == (values[0], values[-1])
        assert abs(sum(v <= middle for v in values) / len(values) - 0.5) < 0.02
    nothing = described(profile(whole.limit(0), "t")).filter("column_name = 'n'").first()
    assert (nothing["row_count"], nothing["null_share"], nothing["quantiles"]) == (0, None, None)
    nested = spark.createDataFrame([([1],)], "a array<int>")
    assert profile(nested, "t").count() == 0


def test_profiles_of_parts_take_one_scan(spark):
    whole = spark.createDataFrame([*measured(4, 600), (None, "c", None, None)], "n int, s string, d double, b boolean")
    part = F.pmod("n", F.lit(3))
    exact = ["column_name", "row_count", "null_count", "least", "greatest", "length_total", "numbers_least", "numbers_greatest"]
    each = profile(whole.filter(part == 0), "t").union(profile(whole.filter(part == 1), "t"))
    each = each.union(profile(whole.filter(part == 2), "t"))
    parts = profile_parts(whole.filter(part.isNotNull()), "t", part)
    assert rows(parts.filter("row_count > 0").select(*exact)) == rows(each.select(*exact))
    assert rows(merged(parts).select(*exact)) == rows(merged(each).select(*exact))
    nothing = merged(profile_parts(whole.limit(0), "t", part))
    assert rows(nothing.select(*exact)) == rows(profile(whole.limit(0), "t").select(*exact))
    scans = profile_parts(spark.range(9).cache(), "t", F.col("id") % 3)._jdf.queryExecution().executedPlan().toString()
    assert scans.count("InMemoryTableScan") == 1
    nested = spark.createDataFrame([([1],)], "a array<int>")
    assert profile_parts(nested, "t", F.lit(0)).count() == 0


def test_numbers_of_a_profile_have_the_ends_of_its_values(spark):
    values = [(3, float("nan"), "NaN"), (-4, 2.5, "zz"), (None, float("-inf"), "a"), (7, None, None)]
    df = spark.createDataFrame(values, "n int, d double, s string").withColumns(
        {"o": F.lit(float("nan")), "t": F.timestamp_seconds("n"), "b": F.col("n") > 0, "z": F.lit(None).cast("double")}
    )
    ends = {r["column_name"]: (r["numbers_least"], r["numbers_greatest"]) for r in profile(df, "t").collect()}
    assert ends == {
        "n": (-4, 7), "d": (float("-inf"), 2.5), "s": (1, 3), "o": (None, None),
        "t": (-4, 7), "b": (0, 1), "z": (None, None),
    }


def test_sketches_are_checked_without_repeating_rows(spark, tmp_path):
    for name in features.PROFILED:
        found = spark.createDataFrame(measured(5, 500), "n int, s string, d double, b boolean")
        number = F.when(~F.isnan("d"), F.col("d")).alias("d")
        found = found.select(F.monotonically_increasing_id().alias("k"), "n", "s", number, F.lit(1).alias("same"))
        found.write.parquet(f"{tmp_path}/{name}.parquet")
    found = features.profile_sketches(spark, str(tmp_path))
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found) == rows(spark.createDataFrame([(t, c, True, True) for t in features.PROFILED for c in ("k", "n", "s", "d", "same")], found.schema))


def test_sketches_out_of_bounds_are_seen(spark):
    df = spark.createDataFrame([(k % 100 if k % 10 else None,) for k in range(1000)], "n int")
    for distinct, median, expected in ((90, 50.0, (True, True)), (80, 50.0, (False, True)), (90, 55.0, (True, False)), (100, 45.0, (False, False))):
        row = Row(distinct_estimate=distinct, quantiles=[median])
        assert tuple(features._within_bounds(df, "t", "n", row).first())[2:] == expected


def test_least_and_greatest_go_by_value(spark):
    parts = [spark.createDataFrame([(v, str(v))], "n int, s string") for v in (9, 10, -3)]
    found = merged(profile(parts[0], "t").union(profile(parts[1], "t")).union(profile(parts[2], "t")))
    ends = {r["column_name"]: (r["least"], r["greatest"]) for r in found.collect()}
    assert ends["n"] == ("-3", "10")


def test_drift_names_what_changed(spark):
    schema = "n int, s string, d double, b boolean"
    before = spark.createDataFrame(measured(1, 2000), schema)
    same = spark.createDataFrame(measured(1, 2000), schema)
    assert drift(profile(before, "t"), profile(same, "t")).count() == 0
    later = before.select(
        (F.col("n") / 4).cast("int").alias("n"), F.lit("a").alias("s"), F.when(F.col("d") < 0.5, F.col("d")).alias("d"), F.lit(1).alias("x")
    )
    found = {r["column_name"]: set(r["findings"]) for r in drift(profile(before, "t"), profile(later, "t")).collect()}
    assert found["n"] >= {"distribution"} and found["s"] >= {"nulls"}
    assert found["d"] >= {"nulls", "distribution"}
    assert found["x"] == {"new"} and found["b"] == {"missing"}


# Clustered files -------------------------------------------------------------------


def test_bits_are_interleaved(spark):
    df = spark.createDataFrame([(5, 3), (0, 0), (7, 7)], "a int, b int")
    found = df.select(interleaved([F.col("a"), F.col("b")], 3)).collect()
    assert [r[0] for r in found] == [0b100111, 0, 0b111111]
    with pytest.raises(ValueError):
        interleaved([F.col("a")] * 11, 6)


def test_a_filter_on_two_keys_reads_a_share_of_the_files(spark, tmp_path):
    df = spark.range(64_000).select(
        F.pmod(F.xxhash64("id"), F.lit(100)).cast("int").alias("a"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("int").alias("b"),
        F.when(F.col("id") % 50 > 0, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(7)).cast("int")).alias("c"),
        "id",
    )
    path = str(tmp_path / "t")
    assert write_clustered(df, ["a", "b"], path, file_rows=1000) == 64_000
    assert rows(spark.read.parquet(path)) == rows(df)
    files, read = glob.glob(f"{path}/*.parquet"), 0
    for file in files:
        found = pq.ParquetFile(file).metadata
        ends = {}
        for group in range(found.num_row_groups):
            for k in range(found.num_columns):
                column = found.row_group(group).column(k)
                ends.setdefault(column.path_in_schema, []).append((column.statistics.min, column.statistics.max))
        fits = lambda name, low, high: any(a <= high and b >= low for a, b in ends[name])
        read += fits("a", 30, 33) and fits("b", 500, 520)
    # 64 files on an 8 x 8 curve: the filter meets few of them. Unsorted, it would meet all.
    assert len(files) >= 60 and read <= 6
    assert spark.read.parquet(path).filter("a BETWEEN 30 AND 33 AND b BETWEEN 500 AND 520").count() == df.filter(
        "a BETWEEN 30 AND 33 AND b BETWEEN 500 AND 520"
    ).count()


def test_copies_of_one_row_do_not_share_one_file(spark, tmp_path):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).cast("int").alias("a"), F.lit(1).alias("b"))
    write_clustered(df, ["a", "b"], str(tmp_path / "t"), file_rows=1000)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(str(tmp_path / "t/*.parquet"))]
    assert max(sizes) < 4000


def test_ranges_of_keys(spark):
    df = spark.createDataFrame([(k,) for k in range(1000)] + [(None,)], "a int")
    bounds = range_bounds(df, ["a"], 2)["a"]
    counts = Counter(r[0] for r in df.select(range_number(F.col("a"), bounds)).collect())
    assert len(counts) == 4 and max(counts.values()) < 300
    assert range_bounds(df.limit(0), ["a"]) == {"a": []}
    assert df.select(range_number(F.col("a"), [])).distinct().count() == 1
