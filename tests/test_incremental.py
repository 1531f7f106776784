"""Daily builds against full ones, ids that stay, lost rows that come back, failures."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import fixture
from starkit.operators.checks import CheckFailed
from starkit.operators.lookup import Lookup, split_lookup, star_lookup
from starkit.plans import incremental, layout
from starkit.plans.incremental import _repeats_for_new_cities, incremental_build, lost_rows, registered
from starkit.plans.model import BuildConfig, load_model, published, run_build, stored_dimensions
from starkit.plans.quarantine import explained, read_rejects, split_feed, write_split

IDS = ("id", "arrival_location_id", "arrlocation_demographics_id")


def rows(df):
    return Counter(map(tuple, df.collect()))


def add_feed(spark, folder, name, feed):
    df = spark.createDataFrame(feed, fixture.FEED_SCHEMA).coalesce(1)
    df = df.select("*", *[F.lit("").alias(column) for column in fixture.EXTRA_COLUMNS])
    df.write.parquet(str(folder / "feed" / name))


@pytest.fixture
def config(spark, tmp_path):
    paths = fixture.write_fixture(spark, tmp_path / "whole")
    return BuildConfig(
        **{**paths, "feed_path": str(tmp_path / "feed/*/*.parquet")},
        target=str(tmp_path / "model"),
        export_maps=False,
    )


@pytest.fixture(autouse=True)
def folder(tmp_path):
    (tmp_path / "whole").mkdir()
    return tmp_path


def by_names(tables):
    """The fact with the members' names in place of generated ids."""
    location = tables["dim_arrival_location"].select(F.col("id").alias("arrival_location_id"), "port_code", "state_code")
    city = tables["dim_demographics"].select(
        F.col("id").alias("arrlocation_demographics_id"), "city", "median_age"
    )
    fact = tables["fact_immigration"].join(location, "arrival_location_id", "left")
    return rows(fact.join(city, "arrlocation_demographics_id", "left").drop(*IDS))


def members(tables):
    return {
        spec.view: rows(tables[spec.view].drop("id") if spec.view in KEYED else tables[spec.view])
        for spec in layout.TABLES
        if spec != layout.FACT
    }


KEYED = ("dim_arrival_location", "dim_demographics")


def ids(tables):
    return {view: {tuple(r)[1:]: r["id"] for r in tables[view].collect()} for view in KEYED}


def full_build(spark, config, folder, name):
    return run_build(spark, BuildConfig(**{**vars(config), "target": str(folder / name)}))[0]


def test_days_add_up_to_a_full_build(spark, config, folder):
    # The first day's row at LOS names another state, so it is lost until LOS is known.
    days = [
        [fixture.FEED[0], ("LOS", "NY", 135.0, 135.0, 20545.0, 2.0, 1.0, 20.0, 1990.0, "F", "XX")],
        [fixture.FEED[1], fixture.FEED[4], fixture.FEED[5]],
        [fixture.FEED[2], fixture.FEED[3], fixture.FEED[6], fixture.FEED[7]],
    ]
    seen = {}
    for number, day in enumerate(days):
        add_feed(spark, folder, f"day-{number}", day)
        tables, metrics = incremental_build(spark, config)
        whole = full_build(spark, config, folder, f"full-{number}")
        assert by_names(tables) == by_names(whole)
        assert members(tables) == members(whole)
        for view, found in ids(tables).items():
            assert len(set(found.values())) == len(found)
            assert seen.get(view, {}).items() <= found.items()
        seen = ids(tables)
        fact_ids = [r["id"] for r in tables["fact_immigration"].select("id").collect()]
        assert len(set(fact_ids)) == len(fact_ids)
        # Every row is a fact row of some city, or lost.
        feed = spark.read.parquet(config.feed_path)
        lost = lost_rows(spark, config.target, feed)
        dims = stored_dimensions(tables)
        wanted = split_feed(feed, dims).filter("reject_reasons != 0").select("feed_row.*", "reject_reasons")
        assert rows(lost) == rows(wanted)
    assert {m.table: m.rows for m in metrics}["fact_immigration"] == 5  # with the first day's at LOS, twice
    assert [entry.kind for entry in published(spark, config.target)] == ["incremental"] * 3


def test_only_new_files_are_read(spark, config, folder, monkeypatch):
    read = []
    stage = incremental.stage_sources
    monkeypatch.setattr(incremental, "stage_sources", lambda s, c: (read.append(c.feed_path), stage(s, c))[1])
    add_feed(spark, folder, "day-0", fixture.FEED[:3])
    incremental_build(spark, config)
    add_feed(spark, folder, "day-1", fixture.FEED[3:])
    incremental_build(spark, config)
    assert [[("day-0" in path, "day-1" in path) for path in paths] for paths in read] == [
        [(True, False)],
        [(False, True)],
    ]


def test_nothing_new_builds_nothing(spark, config, folder):
    add_feed(spark, folder, "day-0", fixture.FEED)
    first, _ = incremental_build(spark, config)
    before = rows(first["fact_immigration"])
    again, metrics = incremental_build(spark, config)
    assert metrics == [] and rows(again["fact_immigration"]) == before
    assert len(published(spark, config.target)) == 1


def test_a_changed_file_fails_and_an_archived_one_does_not(spark, config, folder):
    add_feed(spark, folder, "day-0", fixture.FEED[:3])
    add_feed(spark, folder, "day-1", fixture.FEED[3:5])
    first, _ = incremental_build(spark, config)
    before = rows(first["fact_immigration"])
    for file in (folder / "feed" / "day-0").iterdir():
        file.unlink()
    add_feed(spark, folder, "day-2", fixture.FEED[5:])
    second, _ = incremental_build(spark, config)
    whole = spark.createDataFrame(fixture.FEED, fixture.FEED_SCHEMA).select(
        "*", *[F.lit("").alias(column) for column in fixture.EXTRA_COLUMNS]
    )
    whole.write.parquet(str(folder / "all" / "feed"))
    full = full_build(spark, BuildConfig(**{**vars(config), "feed_path": str(folder / "all/feed")}), folder, "full")
    assert by_names(second) == by_names(full)
    (file,) = (folder / "feed" / "day-1").glob("*.parquet")
    file.chmod(0o644)
    file.write_bytes((folder / "feed" / "day-2").glob("*.parquet").__next__().read_bytes())
    with pytest.raises(CheckFailed, match="changed since"):
        incremental_build(spark, config)
    assert sum(before.values()) <= load_model(spark, config.target)["fact_immigration"].count()


def test_changed_labels_read_everything_and_keep_ids(spark, config, folder):
    add_feed(spark, folder, "day-0", fixture.FEED[:4])
    tables, _ = incremental_build(spark, config)
    before = ids(tables)
    labels = folder / "whole" / "labels.sas"
    # San Francisco goes, and comes back later.
    labels.write_text(fixture.LABELS.replace("\t'SFR'\t=\t'SAN FRANCISCO, CA'\n", ""))
    add_feed(spark, folder, "day-1", fixture.FEED[4:])
    tables, _ = incremental_build(spark, config)
    assert by_names(tables) == by_names(full_build(spark, config, folder, "full-0"))
    assert {r["port_code"] for r in tables["dim_arrival_location"].collect()} == {"LOS", "NYC"}
    labels.write_text(fixture.LABELS)
    tables, metrics = incremental_build(spark, config)
    assert metrics and by_names(tables) == by_names(full_build(spark, config, folder, "full-1"))
    for view, found in before.items():
        assert found.items() <= ids(tables)[view].items()


def test_a_failed_build_leaves_the_model(spark, config, folder, monkeypatch):
    add_feed(spark, folder, "day-0", fixture.FEED[:4])
    first, _ = incremental_build(spark, config)
    before = rows(first["fact_immigration"])
    add_feed(spark, folder, "day-1", fixture.FEED[4:])

    def broken(*_, **__):
        raise OSError("disk full")

    for step in ("write_split", "publish"):
        with monkeypatch.context() as patch:
            patch.setattr(incremental, step, broken)
            with pytest.raises(OSError):
                incremental_build(spark, config)
        assert rows(load_model(spark, config.target)["fact_immigration"]) == before
    tables, _ = incremental_build(spark, config)
    assert by_names(tables) == by_names(full_build(spark, config, folder, "full"))


def test_options_and_empty_feeds(spark, config, folder):
    (folder / "feed").mkdir()
    with pytest.raises(ValueError):
        incremental_build(spark, BuildConfig(**{**vars(config), "fact_keys": "stable"}))
    with pytest.raises(ValueError):
        incremental_build(spark, BuildConfig(**{**vars(config), "partition_fact": True}))
    add_feed(spark, folder, "day-0", [fixture.FEED[4]])  # an unknown port alone
    with pytest.raises(CheckFailed):
        incremental_build(spark, config)
    assert published(spark, config.target) == []


def test_registry_numbers_new_members_behind_all_given(spark):
    first = spark.createDataFrame([("b", None, 1), ("a", "x", 2)], "p string, s string, v int")
    numbered, registry = registered(first, None, ["p", "s"])
    assert rows(numbered) == Counter([(1, "a", "x", 2), (2, "b", None, 1)])
    gone = spark.createDataFrame([("b", None, 9), ("0", "y", 3)], "p string, s string, v int")
    numbered, registry = registered(gone, registry, ["p", "s"])
    assert rows(numbered) == Counter([(2, "b", None, 9), (3, "0", "y", 3)])
    numbered, registry = registered(first, registry, ["p", "s"])
    assert rows(numbered.select("id", "p")) == Counter([(1, "a"), (2, "b")])
    assert rows(registry.select("id")) == Counter([(1,), (2,), (3,)])


def test_new_cities_repeat_earlier_rows(spark):
    before = spark.createDataFrame([(1, "P"), (2, "P"), (3, "Q")], "id long, port_code string")
    after = before.union(spark.createDataFrame([(4, "P"), (5, "P"), (6, "R")], before.schema))
    columns = [c for c in layout.FACT.columns if c != "arrlocation_demographics_id"]
    facts = spark.createDataFrame([(10, 1), (10, 2), (11, 3)], "n int, arrlocation_demographics_id long")
    facts = facts.select("arrlocation_demographics_id", *[F.col("n").alias(c) for c in columns])
    found = _repeats_for_new_cities(facts, before, after, 3)
    assert rows(found.select("airline", "arrlocation_demographics_id")) == Counter([(10, 4), (10, 5)])


# Quarantine ----------------------------------------------------------------------


def test_split_is_the_star_lookup_and_the_rest(spark):
    feed = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 3), (None, 1), (1, 1)], "x int, y int")
    one = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, a int")
    many = spark.createDataFrame([(1, 7), (1, 8), (3, 9), (None, 6)], "k int, b int")
    lookups = [
        Lookup("one", one, {"k": F.col("x")}, {"a": "a"}),
        Lookup("many", many, {"k": F.col("y")}, {"b": "b"}, allow_fanout=True),
        Lookup("again", one, {"k": F.col("x")}, {"a": "c"}),
    ]
    split = split_lookup(feed, lookups)
    kept = star_lookup(feed, lookups)
    assert rows(split.filter("reject_reasons = 0").select(*kept.columns)) == rows(kept)
    lost = split.filter("reject_reasons != 0").select("x", "y", "reject_reasons")
    assert rows(lost) == Counter([(1, 2, 2), (3, 3, 5), (None, 1, 5)])


def test_quarantine_holds_what_the_fact_lacks(spark, config, folder):
    add_feed(spark, folder, "day", fixture.FEED)
    feed = spark.read.parquet(config.feed_path)
    tables = full_build(spark, config, folder, "full")
    dims = stored_dimensions(tables)
    split = split_feed(feed, dims)
    # One scan of the feed, of the columns in use, gives both.
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("i94port#") > 0 and "extra_01" not in plan.split("Relation")[0]
    assert split._jdf.queryExecution().executedPlan().toString().count("i94port:string") == 1
    counts = write_split(split, str(folder / "out"), first_id=100)
    fact = spark.read.schema(layout.FACT.ddl).parquet(str(folder / "out" / layout.FACT_PART))
    assert rows(fact.drop("id")) == rows(tables["fact_immigration"].drop("id"))
    assert counts.fact_rows == fact.count() and counts.next_id == fact.agg(F.max("id")).first()[0] + 1
    assert fact.agg(F.min("id")).first()[0] >= 100
    used = feed.select(*layout.USED_COLUMNS)
    lost = read_rejects(spark, [str(folder / "out" / layout.REJECT_PART)], used)
    assert lost.count() == counts.rejected_rows == 4
    named = {(r["i94port"], r["airline"]): r["reasons"] for r in explained(lost, dims).collect()}
    assert named == {
        ("SFR", None): ["demographics"],
        ("XXX", "BA"): ["location", "demographics"],
        ("NYC", "BA"): ["citizenship"],
        ("LOS", "BA"): ["visa_transport"],
    }
    assert read_rejects(spark, [], used).count() == 0
