"""Shapes of the physical plans that matter at scale."""

import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from starkit.operators.guards import unique_guard_nonnull
from starkit.operators.keys import dense_row_key
from starkit.operators.lookup import Lookup, reject_report, star_lookup
from starkit.plans import reports
from starkit.plans.model import load_model, stored_dimensions
from starkit.plans.fact import fact_rows
from workload.queries import QUERIES
from workload.visits import model_for, sources_for

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not re.search("Python|Pandas|Arrow", plan)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_the_flagship_query_runs(spark):
    rows = entry_module.entry(spark).collect()
    assert rows and rows[0].__fields__ == ["city", "visitor_amount"]


def test_fact_lookups_need_no_shuffle(spark):
    plan = final_plan_of(QUERIES["fact_lookup_rows"](spark, SF_DIR))
    assert plan.count("BroadcastHashJoin") == 5
    assert not re.search(r"\bExchange\b|SortMergeJoin|Sort \[", plan)


def test_fact_reads_only_its_columns(spark):
    dims = stored_dimensions(load_model(spark, model_for(spark, SF_DIR)))
    feed = sources_for(spark, SF_DIR).feed
    plan = plan_of(fact_rows(feed, dims).select("arrival_location_id"))
    assert "airline" not in plan and "biryear" not in plan


def test_report_conditions_reach_the_scan(spark):
    plan = plan_of(QUERIES["report_busiest_weekday"](spark, SF_DIR))
    assert "EqualTo(port_name,NATION_9)" in plan
    assert "EqualTo(month,4)" in plan and "EqualTo(year,1998)" in plan


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["report_top_locations"](spark, SF_DIR))


def test_counts_are_taken_before_labels_are_joined(spark):
    """The fact meets its first aggregate before any join."""
    plan = plan_of(QUERIES["report_top_locations"](spark, SF_DIR))
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "arrival_location_id" in line)
    above = [line for line in lines[:scan]]
    last = [line for line in above if "Aggregate" in line or "Join" in line][-1]
    assert "partial_count" in last


def test_dense_row_keys_share_the_large_shuffle(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    plan = final_plan_of(dense_row_key(lines))
    assert "ReusedExchange" in plan
    assert plan.count("FileScan") == 1


def test_partitioned_fact_is_pruned(spark, tmp_path):
    tables = load_model(spark, model_for(spark, SF_DIR))
    days = tables["dim_arrival_date"].select("arrdate", "year", "month")
    fact = tables["fact_immigration"].join(days, F.col("arrival_date_id") == F.col("arrdate"))
    fact.drop("arrdate").withColumnsRenamed({"year": "arrival_year", "month": "arrival_month"}).write.partitionBy(
        "arrival_year", "arrival_month"
    ).parquet(str(tmp_path / "fact"))
    by_month = {**tables, "fact_immigration": spark.read.parquet(str(tmp_path / "fact"))}
    pruned = reports.busiest_weekday(by_month, "NATION_14", 1998, 4)
    assert re.search(r"PartitionFilters: \[[^\]]*arrival_month", plan_of(pruned))
    assert pruned.collect() == reports.busiest_weekday(tables, "NATION_14", 1998, 4).collect()


@pytest.fixture
def no_broadcast(spark):
    """Sort-merge joins only, with the skew limits low enough to split small data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("fanout", [False, True])
def test_large_dimensions_fall_back_and_split_hot_keys(spark, no_broadcast, fanout):
    """A third of the feed has one key; results and rejects stay whole."""
    feed = spark.range(60_000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("x"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    table = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("ref"))
    lookup = Lookup("big", table, {"k": F.col("x")}, {"ref": "ref"}, allow_fanout=fanout)
    joined = star_lookup(feed, [lookup])
    plan = final_plan_of(joined)
    assert "SortMergeJoin(skew=true)" in plan
    values = [7 if n % 3 == 0 else n % 5000 for n in range(60_000)]
    wanted = Counter((v, v * 10) for v in values if v < 4000)
    assert Counter((r.x, r.ref) for r in joined.select("x", "ref").collect()) == wanted
    report = reject_report(feed, [lookup])
    assert "SortMergeJoin(skew=true)" in final_plan_of(report)
    rejected = {r.lookup_name: r.rejected_rows for r in report.collect()}
    assert rejected == {"big": sum(v >= 4000 for v in values), "any": sum(v >= 4000 for v in values)}


def test_two_large_lookups_by_one_hot_key_are_both_split(spark, no_broadcast):
    """Two lookups on a key with a third of the rows, and a broadcast one between them."""
    feed = spark.range(60_000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("x"),
        (F.col("id") % 3).alias("y"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    table = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("ref"))
    nothing = spark.createDataFrame([(None, 1)], "k long, ref long")
    few = F.broadcast(spark.range(3).select(F.col("id").alias("k"), F.col("id").alias("few")))
    lookups = [
        Lookup("one", table.union(nothing), {"k": F.col("x")}, {"ref": "one"}),
        Lookup("few", few, {"k": F.col("y")}, {"few": "few"}),
        Lookup("two", table.union(nothing), {"k": F.col("x")}, {"ref": "two"}),
    ]
    joined = star_lookup(feed, lookups)
    plan = final_plan_of(joined)
    assert plan.count("SortMergeJoin(skew=true)") == plan.count("SortMergeJoin") == 2
    wanted = sum((7 if n % 3 == 0 else n % 5000) < 4000 for n in range(60_000))
    assert joined.count() == wanted
    # Rejects carry keys and marks only. Sorted by the first join, the hot ones take few
    # bytes, so here the second join need not be split; it could be, as its sides are dealt anew.
    report = reject_report(feed, lookups)
    plan = final_plan_of(report)
    assert "SortMergeJoin(skew=true)" in plan
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 4
    rejected = {r.lookup_name: r.rejected_rows for r in report.collect()}
    assert rejected == {"one": 60_000 - wanted, "few": 0, "two": 60_000 - wanted, "any": 60_000 - wanted}


def test_unknown_members_do_not_shuffle_the_feed(spark, tmp_path):
    """A thousand stored codes and their members are known to be small."""
    tables = load_model(spark, model_for(spark, SF_DIR))
    codes = spark.range(1000).select(
        F.col("id").cast("int").alias("country_code"),
        F.col("id").cast("int").alias("country_id"),
        F.concat(F.lit("country "), F.col("id")).alias("country_name"),
    )
    codes.write.parquet(str(tmp_path / "members"))
    codes.select("country_id", "country_name").write.parquet(str(tmp_path / "countries"))
    dims = replace(
        stored_dimensions(tables),
        country=spark.read.parquet(str(tmp_path / "countries")),
        country_members=spark.read.parquet(str(tmp_path / "members")),
    )
    plan = final_plan_of(fact_rows(sources_for(spark, SF_DIR).feed, dims))
    assert "SortMergeJoin" not in plan
    assert not re.search(r"\bExchange\b", plan)


def test_guard_splits_a_hot_key(spark, no_broadcast):
    """A third of the rows share a key that passes with one non-null value."""
    hot = F.col("id") % 3 == 0
    df = spark.range(60_000).repartition(8).select(
        F.when(hot, -1).otherwise(F.col("id") % 9000).alias("k"),
        F.when(F.col("id").isin(0, 1, 2, 9001), F.col("id")).alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    kept = unique_guard_nonnull(df, ["k"], "v")
    assert "SortMergeJoin(skew=true)" in final_plan_of(kept)
    assert Counter(r.k for r in kept.select("k").collect()) == Counter(
        k for k in (-1 if n % 3 == 0 else n % 9000 for n in range(60_000)) if k in (-1, 2)
    )


def test_the_fact_is_the_same_without_broadcast(spark, no_broadcast):
    dims = stored_dimensions(load_model(spark, model_for(spark, SF_DIR)))
    plain = fact_rows(sources_for(spark, SF_DIR).feed, dims)
    assert "BroadcastHashJoin" not in final_plan_of(plain)
    stored = load_model(spark, model_for(spark, SF_DIR))["fact_immigration"].drop("id")
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, stored.collect()))
