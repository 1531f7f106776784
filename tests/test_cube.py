"""Stored counts give the same reports as the fact."""

from collections import Counter
from dataclasses import replace

import pytest

import fixture
from starkit.operators.checks import CheckFailed
from starkit.plans import cube, reports
from starkit.plans.incremental import incremental_build
from starkit.plans.model import BuildConfig, load_model, run_build

REPORTS = {
    "top_locations": lambda t: reports.top_locations(t),
    "busiest_weekday": lambda t: reports.busiest_weekday(t, "NEW YORK", 2016, 4, 7),
    "top_origins": lambda t: reports.top_origins(t),
    "top_locations_for_origin": lambda t: reports.top_locations_for_origin(t, "CHINA, PRC"),
    "origin_vs_share": lambda t: reports.origin_vs_share(t, "CHINA, PRC"),
    "top_locations_by_purpose": lambda t: reports.top_locations_by_purpose(t, ["Student", "Pleasure"]),
    "share_correlation": lambda t: reports.share_correlation(t, ["JAPAN"]),
    "bucket_by_location": lambda t: reports.bucket_by_location(t),
    "season_histogram": lambda t: reports.season_histogram(t),
    "by_purpose": lambda t: reports.by_purpose(t),
    "by_mode": lambda t: reports.by_mode(t),
    "by_origin_pair": lambda t: reports.by_origin_pair(t),
}


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def config(spark, tmp_path_factory):
    paths = fixture.write_fixture(spark, tmp_path_factory.mktemp("sources"))
    config = BuildConfig(**paths, target=str(tmp_path_factory.mktemp("model")), export_maps=False, cube=True)
    run_build(spark, config)
    return config


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_a_report_from_the_cube_is_the_one_from_the_fact(spark, config, name):
    plain, counted = load_model(spark, config.target), load_model(spark, config.target, cube=True)
    found = REPORTS[name](counted)
    wanted = REPORTS[name](plain)
    assert rows(found) == rows(wanted) and found.dtypes == wanted.dtypes
    # One partition of the cube, and not the fact.
    files = [file.split("/")[-3:-1] for file in found.inputFiles()]
    assert any(folder == "cube.parquet" for folder, _ in files)
    assert not any(folder == "immigration.parquet" or last == "immigration.parquet" for folder, last in files)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("isnotnull(grouping_set") >= 1


def test_one_scan_gives_all_sets(spark, config):
    fact = load_model(spark, config.target)["fact_immigration"]
    made = cube.cube(fact)
    assert made._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    totals = {r["grouping_set"]: r["n"] for r in made.groupBy("grouping_set").agg({"visits": "sum"}).toDF("grouping_set", "n").collect()}
    assert totals == dict.fromkeys(cube.GROUPING_SETS, fact.count())


def test_a_column_that_no_set_has_is_counted_from_the_fact(spark, config):
    tables = load_model(spark, config.target, cube=True)
    assert "visits" not in cube.facts_for(tables, "airline").columns
    assert "visits" in cube.facts_for(tables, "arrival_location_id").columns


def test_cubes_of_daily_builds_add_up(spark, tmp_path):
    (tmp_path / "whole").mkdir()
    paths = fixture.write_fixture(spark, tmp_path / "whole")
    config = BuildConfig(
        **{**paths, "feed_path": str(tmp_path / "feed/*/*.parquet")}, target=str(tmp_path / "m"), export_maps=False, cube=True
    )
    columns = spark.read.parquet(paths["feed_path"]).columns
    for day, part in enumerate((fixture.FEED[:3], fixture.FEED[3:])):
        df = spark.createDataFrame(part, fixture.FEED_SCHEMA).selectExpr(
            *[c if c in fixture.FEED_SCHEMA else f"'' AS {c}" for c in columns]
        )
        df.write.parquet(str(tmp_path / "feed" / f"day-{day}"))
        incremental_build(spark, config)
    plain, counted = load_model(spark, config.target), load_model(spark, config.target, cube=True)
    for report in REPORTS.values():
        assert rows(report(counted)) == rows(report(plain))


def test_a_model_without_a_cube(spark, config, tmp_path):
    other = replace(config, target=str(tmp_path / "m"), cube=False)
    run_build(spark, other)
    with pytest.raises(CheckFailed, match="cube"):
        load_model(spark, other.target, cube=True)
