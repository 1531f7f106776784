"""Bad input must raise, or give the documented null."""

from collections import Counter

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

import fixture
from starkit.functions import day_to_iso, percent, register_day_function
from starkit.operators.checks import CheckFailed, require_keys, require_unique
from starkit.operators.lookup import Lookup, star_lookup
from starkit.operators.keys import dense_row_key
from starkit.plans import model
from starkit.plans.dimensions import (
    country_dimension,
    country_dimension_unknown_member,
    date_dimension,
)
from starkit.plans.fact import fact_rejects
from starkit.plans.layout import (
    COUNTRY_MAP,
    PORT_MAP,
    STATE_MAP,
    TABLES,
    TRANSPORT_MAP,
    VISA_MAP,
)
from starkit.plans.model import (
    BuildConfig,
    current_folder,
    load_model,
    run_build,
    stored_dimensions,
)
from starkit.sources.labels import parse_sections, read_label_texts
from starkit.sources.staging import SourceSpec, read_source, stage


def test_empty_source(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "t"))
    with pytest.raises(CheckFailed, match="no rows"):
        stage(spark, [SourceSpec("t", str(tmp_path / "t"))])


def test_file_without_a_usable_row_is_empty(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;b\nbad\nworse\n")
    spec = SourceSpec("t", str(tmp_path / "t.csv"), "csv", schema="a int, b int", separator=";")
    with pytest.raises(CheckFailed, match="no rows"):
        stage(spark, [spec])


def test_wrong_column_count(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t"))
    with pytest.raises(CheckFailed, match="columns"):
        stage(spark, [SourceSpec("t", str(tmp_path / "t"), columns=2)])


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        read_source(spark, SourceSpec("t", "nowhere", "xml"))


@pytest.mark.parametrize("text", ["value other\n1='a'\n;", "value wanted\n1='a'\n"])
def test_missing_section_or_end(spark, tmp_path, text):
    (tmp_path / "labels").write_text(text)
    entries = parse_sections(read_label_texts(spark, str(tmp_path / "labels")), ["wanted"])
    with pytest.raises(PySparkException, match="section"):
        entries.collect()


def test_label_text_rules(spark, tmp_path):
    (tmp_path / "labels").write_bytes(
        b"value wanted 0 = 'first line'\r\n1='one'\r\n 2 = 'it''s'\r\n3=''\r\n='x'\r\n"
        b"1\t=\t' last\xc2\xa0'\n4=a=b\n5 = 'cut; 6 = 'late'\n"
    )
    entries = parse_sections(read_label_texts(spark, str(tmp_path / "labels")), ["wanted"])
    found = {(r.code, r.label) for r in entries.collect()}
    assert found == {("1", "last"), ("2", "its"), ("3", None), (None, "x"), ("5", "cut")}


def test_later_files_win(spark, tmp_path):
    (tmp_path / "a.txt").write_text("wanted\n1 = 'old'\n2 = 'two'\n;")
    (tmp_path / "b.txt").write_text("wanted\n1 = 'new'\n;")
    entries = parse_sections(read_label_texts(spark, str(tmp_path)), ["wanted"])
    assert {(r.code, r.label) for r in entries.collect()} == {("1", "new"), ("2", "two")}


def test_null_day_and_zero_whole(spark):
    df = spark.createDataFrame([(None, 0), (20545.0, 4)], "day double, whole int")
    found = df.select(day_to_iso(F.col("day")), percent(F.lit(1), F.col("whole"))).collect()
    assert [tuple(r) for r in found] == [(None, None), ("2016-04-01T00:00:00", 25.0)]


def test_day_function_in_sql(spark):
    register_day_function(spark)
    found = spark.sql("SELECT get_datetime(20545.0D), get_datetime(NULL), get_datetime(-1)").first()
    assert tuple(found) == ("2016-04-01T00:00:00", None, "1959-12-31T00:00:00")


def test_ambiguous_lookup(spark):
    feed = spark.createDataFrame([(1,)], "x int")
    twice = spark.createDataFrame([(1, 10), (1, 11)], "k int, id int")
    with pytest.raises(CheckFailed, match="not unique"):
        star_lookup(feed, [Lookup("twice", twice, {"k": F.col("x")}, {"id": "id"})])
    with pytest.raises(CheckFailed):
        require_unique(twice, "twice", ["k"])


def test_failed_check_keeps_the_earlier_model(spark, tmp_path):
    paths = fixture.write_fixture(spark, tmp_path)
    config = BuildConfig(**paths, target=str(tmp_path / "model"), export_maps=False)
    run_build(spark, config)
    before = {spec.view: Counter(load_model(spark, config.target)[spec.view].collect()) for spec in TABLES}
    # No feed row has a port the map knows.
    feed = spark.createDataFrame(fixture.FEED, fixture.FEED_SCHEMA).withColumn("i94port", F.lit("ZZZ"))
    feed.select("*", *[F.lit("").alias(n) for n in fixture.EXTRA_COLUMNS]).write.parquet(
        str(tmp_path / "other")
    )
    bad = BuildConfig(**{**paths, "feed_path": str(tmp_path / "other")}, target=config.target, export_maps=False)
    with pytest.raises(CheckFailed, match="dim_arrival_location"):
        run_build(spark, bad)
    after = load_model(spark, config.target)
    assert {view: Counter(after[view].collect()) for view in before} == before


def contents(spark, config):
    folder = current_folder(spark, config.target)
    found = {spec.view: Counter(load_model(spark, config.target)[spec.view].collect()) for spec in TABLES}
    for spec in (COUNTRY_MAP, PORT_MAP, STATE_MAP, TRANSPORT_MAP, VISA_MAP):
        found[spec.view] = Counter(spark.read.text(f"{folder}/{spec.file}").collect())
    return found


def other_feed(spark, path, **columns):
    feed = spark.createDataFrame(fixture.FEED, fixture.FEED_SCHEMA).withColumns(columns)
    feed.select("*", *[F.lit("").alias(n) for n in fixture.EXTRA_COLUMNS]).write.parquet(str(path))
    return {"feed_path": str(path)}


def test_failed_fact_keeps_the_earlier_model(spark, tmp_path, monkeypatch):
    paths = fixture.write_fixture(spark, tmp_path)
    config = BuildConfig(**paths, target=str(tmp_path / "model"))
    run_build(spark, config)
    before = contents(spark, config)
    view = Counter(spark.table("fact_immigration").collect())
    # No feed row has a visa the model knows, so the fact is empty.
    unknown = other_feed(spark, tmp_path / "visa", i94visa=F.lit(8.0))
    with pytest.raises(CheckFailed, match="fact_immigration"):
        run_build(spark, BuildConfig(**{**paths, **unknown}, target=config.target))
    assert contents(spark, config) == before

    def broken(*_):
        raise OSError("disk full")

    # One location less, so that ids change their meaning; then the fact's write fails.
    fewer = other_feed(spark, tmp_path / "port", i94port=F.lit("NYC"), i94addr=F.lit("NY"))
    monkeypatch.setattr(model, "write_fact", broken)
    with pytest.raises(OSError):
        run_build(spark, BuildConfig(**{**paths, **fewer}, target=config.target))
    assert contents(spark, config) == before
    assert Counter(spark.table("fact_immigration").collect()) == view


def test_a_target_without_a_published_build(spark, tmp_path):
    with pytest.raises((CheckFailed, AnalysisException)):
        load_model(spark, str(tmp_path / "nothing"))


def test_days_and_codes_without_a_key(spark, tmp_path):
    days = spark.createDataFrame([(20545.0,), (None,), (20545.0,)], "arrdate double")
    assert [r.arrdate for r in date_dimension(days).collect()] == [20545]
    feed = spark.createDataFrame([("135", "135.0"), ("135.5", None)], "i94cit string, i94res string")
    names = spark.createDataFrame([(135, "UNITED KINGDOM")], "country_id int, country_name string")
    assert [tuple(r) for r in country_dimension(feed, names).collect()] == [(135, "UNITED KINGDOM")]
    members = names.withColumn("country_code", F.col("country_id"))
    assert [tuple(r) for r in country_dimension_unknown_member(feed, members).collect()] == [
        (135, "UNITED KINGDOM")
    ]
    with pytest.raises(CheckFailed, match="is null"):
        require_keys(names.withColumn("country_id", F.lit(None)), "names", ["country_id"])


def test_too_many_buckets(spark):
    with pytest.raises(ValueError, match="at most"):
        dense_row_key(spark.range(3), buckets=16**6)


def test_rejects_are_reported_with_the_build(spark, tmp_path):
    paths = fixture.write_fixture(spark, tmp_path)
    config = BuildConfig(**paths, target=str(tmp_path / "m"), count_rejects=True, map_delimiter="|")
    tables, metrics = run_build(spark, config)
    found = {m.table: m.rows for m in metrics if m.table.startswith("rejected:")}
    feed = spark.read.parquet(paths["feed_path"])
    wanted = fact_rejects(feed, stored_dimensions(tables)).collect()
    assert found == {f"rejected:{r.lookup_name}": r.rejected_rows for r in wanted} | {
        "rejected:without_day": feed.filter("arrdate IS NULL").count()
    }
    folder = current_folder(spark, config.target)
    lines = {r.value for r in spark.read.text(f"{folder}/{VISA_MAP.file}").collect()}
    assert "1|Business" in lines


@pytest.mark.parametrize("option", [{"unknown_countries": "guess"}, {"fact_keys": "guess"}])
def test_unknown_options(spark, tmp_path, option):
    paths = fixture.write_fixture(spark, tmp_path)
    with pytest.raises(ValueError):
        run_build(spark, BuildConfig(**paths, target=str(tmp_path / "m"), export_maps=False, **option))
