"""Queries on daily builds, kept lost rows, captured lines, drifting feeds and similar names."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from starkit.operators.lookup import REASONS, reason_names
from starkit.operators.profiles import (
    DISTINCT_ERROR,
    PROFILE,
    RANK_ERROR,
    described,
    drift,
    merged,
    profile,
    profile_parts,
)
from starkit.operators.similar import nearest_names, similar_names
from starkit.plans import layout, reports
from starkit.plans.builds import INCREMENTAL, published
from starkit.plans.clustered import write_clustered
from starkit.plans.cube import CUBE_DIRECTORY, write_cube
from starkit.plans.fact import fact_lookups
from starkit.plans.incremental import incremental_build
from starkit.plans.maintenance import bag_diff, build_diff, compact, keyed_diff
from starkit.plans.model import load_model, stored_dimensions
from starkit.plans.quarantine import explained, read_rejects, split_feed, write_split
from starkit.session import scratch_path
from starkit.sources.capture import capture_csv
from starkit.sources.drift import read_drifting
from starkit.sources.staging import SourceSpec
from workload.visits import model_for, sources_for, table, write_sources

# Customers in a file of lines, so that the place of each line is known.
FILE_LINES = 1000


# Lost rows


def _split(spark: SparkSession, sf_dir: str):
    feed = sources_for(spark, sf_dir).feed
    dims = stored_dimensions(load_model(spark, model_for(spark, sf_dir)))
    folder = scratch_path(spark, "split")
    counts = write_split(split_feed(feed, dims), folder)
    return feed, dims, folder, counts


def fact_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lost feed row with the lookups that lost it."""
    feed, dims, folder, _ = _split(spark, sf_dir)
    used = feed.select(*layout.USED_COLUMNS)
    lost = explained(read_rejects(spark, [f"{folder}/{layout.REJECT_PART}"], used), dims)
    return lost.select(
        F.col(layout.PORT).alias("port"),
        F.col(layout.STATE).alias("state"),
        *[F.col(c).cast("int").alias(c) for c in (layout.CITIZENSHIP, layout.RESIDENCE, layout.ARRIVAL_DAY)],
        F.col(layout.TRANSPORT).cast("int").alias("transport"),
        F.col(layout.AIRLINE).alias("airline"),
        F.col(REASONS),
        F.array_join("reasons", "+").alias("reasons"),
    )


def fact_quarantine_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the written table by reason: fact rows, and lost ones."""
    _, dims, folder, _ = _split(spark, sf_dir)
    rows = spark.read.schema(f"{REASONS} int").parquet(f"{folder}/{layout.SPLIT}")
    counted = rows.groupBy(REASONS).agg(F.count(F.lit(1)).alias("row_count"))
    names = reason_names(fact_lookups(dims), F.col(REASONS))
    return counted.withColumn("reasons", F.array_join(names, "+"))


# Daily builds


def delivery_day() -> Column:
    """Three deliveries: ports with odd codes are unknown until the second, and have rows before
    that are lost at first."""
    odd = F.col(layout.PORT).try_cast("int") % 2 == 1
    home = F.col(layout.STATE) == (F.col(layout.PORT).try_cast("int") % 5).cast("string")
    late = F.col(layout.ARRIVAL_DAY).cast("int") % 3
    return F.when(odd & home, F.when(late == 0, 2).otherwise(1)).otherwise(F.when(late == 1, 1).otherwise(0))


_daily: dict[tuple[str, str], tuple[str, list[str]]] = {}


def _daily_target(spark: SparkSession, sf_dir: str) -> tuple[str, list[str]]:
    """The target of three incremental builds, and their folders in order; built once per
    application and data folder."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _daily:
        written = write_sources(spark, sf_dir, F.coalesce(delivery_day(), F.lit(0)))
        # The feed is joined and written once; each build finds one delivery more.
        for days in ("0", "0,1", "0,1,2"):
            config = replace(written, feed_path=f"{written.feed_path}/delivery={{{days}}}/*.parquet", cube=True)
            incremental_build(spark, config)
        entries = published(spark, config.target, INCREMENTAL)
        folders = [f"{config.target}/{entry.build}" for entry in reversed(entries)]
        _daily[key] = config.target, folders
    return _daily[key]


def incremental_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of three daily builds, with names for the ids that depend on the order of days."""
    target, _ = _daily_target(spark, sf_dir)
    tables = load_model(spark, target)
    location = tables[layout.LOCATION.view].select(F.col("id").alias("arrival_location_id"), "port_code", "state_code")
    city = tables[layout.DEMOGRAPHICS.view].select(
        F.col("id").alias("arrlocation_demographics_id"), "city", "median_age"
    )
    fact = tables[layout.FACT.view].join(location, "arrival_location_id")
    return fact.join(city, "arrlocation_demographics_id").drop(
        "id", "arrival_location_id", "arrlocation_demographics_id"
    )


def incremental_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each dimension with generated ids: members after the first and the last build, first
    ones whose id is the same, and ids in use."""
    _, folders = _daily_target(spark, sf_dir)
    parts = []
    for spec in (layout.LOCATION, layout.DEMOGRAPHICS):
        first, last = (spark.read.schema(spec.ddl).parquet(f"{f}/{spec.directory}") for f in (folders[0], folders[-1]))
        kept = first.select(*spec.columns, F.lit(1).alias("first")).unionByName(
            last.select(*spec.columns, F.lit(0).alias("first"))
        )
        both = kept.groupBy(*spec.columns).agg(F.count_if(F.col("first") == 1).alias("f"), F.count_if(F.col("first") == 0).alias("l"))
        parts.append(
            both.agg(
                F.sum("f").alias("first_members"),
                F.sum("l").alias("last_members"),
                F.sum(F.col("f") * F.col("l")).alias("kept_ids"),
                F.count_distinct("id").alias("ids"),
            ).select(F.lit(spec.view).alias("table_name"), "*")
        )
    return reduce(DataFrame.union, parts)


# Captured lines


def _numbered_lines(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Customers as delimited files of ``FILE_LINES`` customers, in order; behind every tenth
    stands a broken line: too short, too long, or with a word for a number."""
    path = scratch_path(spark, "customer-lines")
    customers = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    good = F.concat_ws(";", *customers.columns)
    broken = F.concat(F.lit("broken;line-"), key.cast("string"))
    broken = F.when(key % 30 == 10, F.concat(good, F.lit(";more"))).otherwise(broken)
    broken = F.when(key % 30 == 20, F.concat(F.lit("x"), good)).otherwise(broken)
    lines = F.when(key % 10 == 0, F.array(good, broken)).otherwise(F.array(good))
    header = ";".join(customers.columns)
    (
        customers.withColumn("file", F.floor(key / FILE_LINES))
        .select("file", key, F.posexplode(lines).alias("n", "line"))
        .repartition("file")
        .sortWithinPartitions("file", "c_custkey", "n")
        .select("file", F.col("line").alias(header))
        .write.partitionBy("file")
        .option("header", True)
        .option("sep", "\t")
        .option("quote", "")
        .csv(path)
    )
    return f"{path}/*", customers


def scan_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broken lines with their file and place, of files with one in eleven."""
    path, customers = _numbered_lines(spark, sf_dir)
    spec = SourceSpec("customers", path, "csv", schema=customers.schema, separator=";")
    captured = capture_csv(spark, spec, tolerance=0.2)
    number = F.regexp_extract("file", r"file=(\d+)", 1).cast("int")
    return captured.bad.select(number.alias("file_number"), F.col("record").cast("bigint").alias("record"), "line")


def scan_csv_captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good rows of the same files."""
    path, customers = _numbered_lines(spark, sf_dir)
    spec = SourceSpec("customers", path, "csv", schema=customers.schema, separator=";")
    return capture_csv(spark, spec, tolerance=0.2).good


# Drifting feeds


def scan_drifting_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in files whose quantity is int, double or missing, whose line number is int or
    bigint, whose names differ in case, and one file whose quantity is text, which is left out."""
    path = scratch_path(spark, "drifting")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"
    )
    number, quantity = F.col("l_linenumber"), F.col("l_quantity")
    files = {
        1: {"l_quantity": quantity.cast("int"), "l_linenumber": number.cast("int")},
        2: {"l_quantity": quantity.cast("double"), "l_linenumber": number.cast("bigint")},
        3: {"l_quantity": None},
        4: {"l_shipdate": None, "l_returnflag": None},
        5: {"l_quantity": F.concat(quantity.cast("string"), F.lit(" pcs"))},
    }
    for remainder, changes in files.items():
        part = lines.filter(F.col("l_orderkey") % 6 == remainder)
        for name, change in changes.items():
            part = part.drop(name) if change is None else part.withColumn(name, change)
        if remainder == 4:
            part = part.withColumnRenamed("l_linenumber", "L_LineNumber")
        part.write.parquet(f"{path}/part-{remainder}")
    lines.filter(F.col("l_orderkey") % 6 == 0).write.parquet(f"{path}/part-0")
    read = read_drifting(spark, f"{path}/*", skip_incompatible=True)
    names = {"l_linenumber": "bigint", "l_quantity": "double"}
    return read.df.select(*[F.col(c).cast(names[c]).alias(c) if c in names else c for c in lines.columns])


# Similar names


def _spelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Names of letters for the customers, by nation, and the same names with an edit or two."""
    letters = F.regexp_replace(F.md5(F.col("c_custkey").cast("string")), "[0-9]", "")
    right = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", letters.alias("name"))
    size, key = F.char_length("name"), F.col("c_custkey")
    cut = F.concat(F.substring("name", 1, 3), F.substring("name", 5, 99))
    swapped = F.concat(F.substring("name", 1, 2), F.substring("name", 4, 1), F.substring("name", 3, 1), F.substring("name", 5, 99))
    edited = F.when(key % 4 == 0, cut).when(key % 4 == 1, swapped).when(key % 4 == 2, F.concat("name", F.lit("z")))
    left = right.withColumn("name", F.when(size >= 5, edited.otherwise(F.col("name"))).otherwise(F.col("name")))
    return left.select("c_nationkey", "name"), right.select("c_nationkey", "name")


def join_similar_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of differently spelled names of a nation within two edits."""
    left, right = _spelled(spark, sf_dir)
    return similar_names(left, right, ["c_nationkey"], 2)


def join_nearest_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each name that its nation lacks, the nearest within two edits."""
    left, right = _spelled(spark, sf_dir)
    found = nearest_names(left, right, ["c_nationkey"], 2)
    return found.withColumn("rivals", F.col("rivals").cast("bigint"))


# Cube


def report_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored counts of all grouping sets of the fact."""
    folder = scratch_path(spark, "cube")
    write_cube(load_model(spark, model_for(spark, sf_dir))[layout.FACT.view], folder)
    return spark.read.parquet(f"{folder}/{CUBE_DIRECTORY}")


def report_cube_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors by quarter and city from the cubes of three daily builds."""
    target, _ = _daily_target(spark, sf_dir)
    return reports.season_histogram(load_model(spark, target, cube=True))


# Builds over time


def keyed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers against a later state with planted changes."""
    before = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    after = before.filter(key % 50 != 7).withColumns(
        {
            "c_acctbal": F.when(key % 7 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")),
            "c_mktsegment": F.when(key % 11 == 0, F.lit("OTHER")).otherwise(F.col("c_mktsegment")),
            "c_custkey": F.when(key % 50 == 8, key + 10**9).otherwise(key),
        }
    )
    found = keyed_diff(before, after, ("c_custkey",))
    return found.withColumn("columns", F.array_join("columns", "+"))


def bag_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items without their key, against a later state with fewer and more of some."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_orderkey")
    before = lines.filter("l_orderkey % 100 != 1").drop("l_orderkey")
    after = lines.filter("l_orderkey % 100 != 2 AND NOT (l_returnflag = 'R' AND l_linenumber = 7)")
    return bag_diff(before, after.drop("l_orderkey"))


def build_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members that the later of three daily builds added to the first one's."""
    target, _ = _daily_target(spark, sf_dir)
    numbers = sorted(entry.number for entry in published(spark, target, INCREMENTAL))
    return build_diff(spark, target, numbers[0], numbers[-1]).drop("columns")


def fact_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of three daily builds after its parts were rewritten as one."""
    target, _ = _daily_target(spark, sf_dir)
    compact(spark, target)
    return incremental_fact(spark, sf_dir)


# Profiles and layout

PROFILED = ("customer", "orders", "lineitem", "supplier", "part")


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of some tables, merged from those of three parts of each."""
    parts = []
    for name in PROFILED:
        df = table(spark, sf_dir, name)
        third = F.pmod(F.col(df.columns[0]), F.lit(3))
        parts.append(profile_parts(df.filter(third.isNotNull()), name, third))
    stored = scratch_path(spark, "profiles")
    reduce(DataFrame.union, parts).write.parquet(stored)
    return merged(spark.read.schema(PROFILE).parquet(stored))


def profile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact parts of the merged profiles."""
    found = described(_profiles(spark, sf_dir))
    exact = ["table_name", "column_name", "row_count", "null_count", "least", "greatest"]
    return found.select(*exact, F.round("mean_length", 6).alias("mean_length"))


def _within_bounds(df: DataFrame, name: str, column: str, row: Row) -> DataFrame:
    """One row: whether a column's sketches are within their bounds. The column is scanned alone
    and reduced to its values with their counts, from which all exact figures come."""
    kind = df.schema[column].dataType.simpleString()
    values = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("times"))
    exact = F.count("value")
    near = F.abs(F.lit(row["distinct_estimate"]) - exact) <= DISTINCT_ERROR * exact
    middle = F.lit(True)
    if kind in ("bigint", "int", "double"):

        def rows(condition: Column) -> Column:
            return F.coalesce(F.sum(F.when(condition, F.col("times"))), F.lit(0))

        number, median = F.col("value").cast("double"), row["quantiles"][0]
        count = rows(F.col("value").isNotNull())
        half, slack = count / 2, RANK_ERROR * count + 1
        middle = (rows(number < median) - slack <= half) & (half <= rows(number <= median) + slack)
    return values.agg(
        F.lit(name).alias("table_name"),
        F.lit(column).alias("column_name"),
        near.alias("distinct_near"),
        middle.alias("median_near"),
    )


def profile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether distinct counts and medians of the sketches are within their bounds."""
    # One row a column: what is known of a table is the same for any number of rows.
    found = {(r["table_name"], r["column_name"]): r for r in described(_profiles(spark, sf_dir), (0.5,)).collect()}
    tables = {name: table(spark, sf_dir, name) for name in PROFILED}
    checks = [_within_bounds(df, name, c, found[name, c]) for name, df in tables.items() for c in df.columns]
    return reduce(DataFrame.union, checks)


def profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed from orders to a later state with planted changes."""
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    later = orders.withColumns(
        {
            "o_totalprice": F.col("o_totalprice") * 3,
            "o_orderstatus": F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderstatus")),
            "o_custkey": F.col("o_custkey") % 100,
            "o_extra": F.lit(1),
        }
    ).drop("o_orderpriority")
    found = drift(profile(orders, "orders"), profile(later, "orders"))
    return found.withColumn("findings", F.array_join("findings", "+"))


def fact_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows of one place and some days, from a fact stored by place, day and citizenship."""
    fact = load_model(spark, model_for(spark, sf_dir))[layout.FACT.view]
    path = scratch_path(spark, "clustered")
    keys = ["arrival_location_id", "arrival_date_id", "country_id_citizenship"]
    write_clustered(fact, keys, path, file_rows=max(1, fact.count() // 64))
    stored = spark.read.schema(layout.FACT.ddl).parquet(path)
    return stored.filter("arrival_location_id = 3 AND arrival_date_id BETWEEN 13500 AND 14000").drop("id")


QUERIES = {
    "fact_quarantine": fact_quarantine,
    "fact_quarantine_balance": fact_quarantine_balance,
    "incremental_build": incremental_fact,
    "incremental_keys": incremental_keys,
    "scan_csv_quarantine": scan_csv_quarantine,
    "scan_csv_captured": scan_csv_captured,
    "scan_drifting_feed": scan_drifting_feed,
    "join_similar_place": join_similar_place,
    "join_nearest_place": join_nearest_place,
    "keyed_diff": keyed_changes,
    "bag_diff": bag_changes,
    "build_diff": build_changes,
    "fact_compacted": fact_compacted,
    "profile_tables": profile_tables,
    "profile_sketches": profile_sketches,
    "profile_drift": profile_drift,
    "fact_clustered": fact_clustered,
    "report_cube": report_cube,
    "report_cube_daily": report_cube_daily,
}
