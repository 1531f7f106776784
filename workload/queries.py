"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.functions import (
    day_to_iso,
    number_to_int,
    place_name,
    place_state,
    register_day_function,
    text_to_double,
    text_to_float,
    text_to_long,
)
from starkit.operators.checks import code_lengths, column_counts, row_counts
from starkit.operators.guards import duplicate_keys, unique_guard, unique_guard_nonnull
from starkit.operators.keys import dense_key, dense_row_key, row_key
from starkit.operators.pivot import pivot_sum
from starkit.plans import dimensions, layout, reports
from starkit.plans.codemaps import cluster_unknown, export_code_maps
from starkit.plans.fact import fact_rejects, fact_rows
from starkit.plans.model import build_model, load_model, stored_dimensions, write_fact
from starkit.plans.sqltables import SqlTable, build_sql_tables
from starkit.session import scratch_path
from starkit.sources.labels import literal_map, parse_sections, read_label_texts
from starkit.sources.mapfiles import read_code_map, write_code_map
from starkit.sources.staging import SourceSpec, normalize_column_names, read_source, stage
from workload import features
from workload.visits import config_for, model_for, sources_for, table, transport_labels

Query = Callable[[SparkSession, str], DataFrame]

GIVEN_TABLES = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
    "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3,
    "benchmark": 2, "labels": 3, "conversations": 4,
}
LABEL_FILE_ENTRIES = 10_000
LINE_KEY = ["l_orderkey", "l_linenumber"]


# Sources and staging


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, SourceSpec("customers", f"{sf_dir}/custom*.parquet"))


def scan_csv_dropmalformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as text with a broken line after every tenth."""
    path = scratch_path(spark, "customers-csv")
    good = F.concat_ws(";", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    lines = F.when(F.col("c_custkey") % 10 == 0, F.array(good, F.lit("broken;line"))).otherwise(
        F.array(good)
    )
    customers = table(spark, sf_dir, "customer")
    # A text file has no header of its own, so each part gets the same first line.
    customers.select(F.explode(lines).alias("line")).select(
        F.col("line").alias("c_custkey;c_name;c_nationkey;c_acctbal;c_mktsegment")
    ).write.option("header", True).option("sep", "\t").option("quote", "").csv(path)
    spec = SourceSpec("customers", path, "csv", schema=customers.schema, separator=";")
    return read_source(spark, spec)


def stage_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [
        SourceSpec(f"staging_{name}", f"{sf_dir}/{name}.parquet", columns=columns)
        for name, columns in GIVEN_TABLES.items()
    ]
    staged = {view: source.df for view, source in stage(spark, specs).items()}
    return column_counts(staged, {f"staging_{n}": c for n, c in GIVEN_TABLES.items()}).select(
        "table_name", "row_count", "column_count"
    )


def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return normalize_column_names(
        customers.toDF("Cust Key", "Full Name", "Nation-Key", "Acct  Bal", "Market Segment")
    )


# Code maps


def _part_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label texts for the parts, some ten thousand entries per file, parsed back.

    Every fifth entry is preceded by a wrong one; every seventh has two equal signs.
    """
    path = scratch_path(spark, "part-labels")
    key = F.col("p_partkey").cast("string")

    def line(label):
        return F.concat(F.lit("\t"), key, F.lit("\t= '"), label, F.lit("'  "))

    right = F.when(F.col("p_partkey") % 7 == 3, line(F.lit("A = B"))).otherwise(line("p_name"))
    lines = F.when(F.col("p_partkey") % 5 == 2, F.array(line(F.lit("WRONG")), right)).otherwise(
        F.array(right)
    )
    parts = table(spark, sf_dir, "part").withColumn(
        "file", F.floor(F.col("p_partkey") / LABEL_FILE_ENTRIES)
    )
    entries = parts.select("file", "p_partkey", F.posexplode(lines).alias("n", "line"))

    def mark(place, text):
        return F.struct(
            F.lit(place).cast("bigint").alias("p_partkey"), F.lit(0).alias("n"), F.lit(text).alias("line")
        )

    frame = F.array(mark(-1, "value partl"), mark(2**62, ";"))
    frames = parts.select("file").distinct().select("file", F.inline(frame))
    (
        entries.union(frames)
        .repartition("file")
        .sortWithinPartitions("file", "p_partkey", "n")
        .select("file", "line")
        .write.partitionBy("file")
        .text(path)
    )
    return parse_sections(read_label_texts(spark, path), ["partl"]).select("code", "label")


def codemap_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_entries(spark, sf_dir).na.drop("any")


def codemap_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "part-map")
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("code"),
        F.concat(F.col("p_name"), F.lit(" '"), F.col("p_brand"), F.lit("|")).alias("label"),
    )
    write_code_map(parts, path, "|")
    return read_code_map(spark, path, "code string, label string", "|")


def codemap_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    visas = literal_map(spark, layout.VISA_TYPES, "visa_code", "visa_type")
    code = F.when(F.col("l_returnflag") == "A", "1").when(F.col("l_returnflag") == "N", "2")
    lines = table(spark, sf_dir, "lineitem").groupBy(code.otherwise("3").alias("visa_code")).count()
    return lines.join(visas, "visa_code").select(
        "visa_code", "visa_type", F.col("count").alias("row_count")
    )


def split_place_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    comma = F.when(F.col("c_custkey") % 3 == 0, " ").when(F.col("c_custkey") % 3 == 1, " ,  ")
    label = F.concat("c_name", comma.otherwise(", "), "c_mktsegment", F.lit(" "))
    customers = table(spark, sf_dir, "customer")
    return customers.select(
        "c_custkey",
        place_name(label).alias("place_name"),
        place_state(label).alias("place_state"),
    ).na.drop("any")


def cluster_unknown_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    mark = F.when(segment == "BUILDING", "INVALID: ").when(segment == "FURNITURE", "Collapsed ")
    codes = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("country_code"),
        F.concat(mark.otherwise(""), "c_name").alias("country_name"),
    )
    return cluster_unknown(codes)


def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    ).na.drop("any")


def typed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.col("c_custkey") % 10 == 0
    text = F.when(bad, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text_to_double(text).alias("as_double"),
        text_to_float(text).alias("as_float"),
        text_to_long(text).alias("as_long"),
        number_to_int(text).alias("as_int"),
    )


# Joins, guards, sets, pivots, keys


def join_case_insensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    left = customers.select("c_custkey", "c_nationkey", F.upper("c_name").alias("left_name"))
    right = customers.select(
        F.initcap("c_name").alias("right_name"),
        F.col("c_nationkey").alias("right_nation"),
        "c_acctbal",
    )
    same = (F.lower("left_name") == F.lower("right_name")) & (
        F.col("c_nationkey") == F.col("right_nation")
    )
    return left.join(right, same).select("c_custkey", "left_name", "right_name", "c_acctbal")


def unique_guard_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_partkey")
    return unique_guard(lines, LINE_KEY)


def unique_guard_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_partkey")
    return unique_guard(lines, ["l_orderkey"])


def unique_guard_nonnull_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.when(F.col("l_linenumber") == 1, F.col("l_partkey"))
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, first.alias("first_part"))
    return unique_guard_nonnull(lines, ["l_orderkey"], "first_part")


def duplicate_key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), LINE_KEY)


def union_distinct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.observed_countries(sources_for(spark, sf_dir).feed)


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


def pivot_long_to_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linestatus", "l_returnflag", "l_quantity"
    )
    # R is not listed: orders with nothing else keep a row of nulls.
    names = {"A": "quantity_a", "N": "quantity_n"}
    return pivot_sum(lines, "l_returnflag", F.col("l_quantity"), names, "l_quantity")


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_name", "c_custkey")
    return dense_key(customers, ["c_custkey"])


def surrogate_key_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items by all columns, numbered 1..N."""
    return dense_row_key(table(spark, sf_dir, "lineitem"), bucket_on=[*LINE_KEY, "l_partkey"])


def surrogate_key_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few distinct rows with very many copies, in spans of a thousand."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    return row_key(lines, copy_span=1000)


# Dates and dimensions


def sas_day_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    offset = F.when(
        F.col("o_orderkey") % 50 != 0,
        F.datediff(F.col("o_orderdate").cast("date"), F.lit("1960-01-01").cast("date")),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", offset.alias("day_offset"))
    return orders.withColumn("day_text", day_to_iso(F.col("day_offset")))


def sql_day_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_day_function(spark)
    table(spark, sf_dir, "orders").createOrReplaceTempView("staging_orders")
    return spark.sql(
        """SELECT get_datetime(datediff(CAST(o_orderdate AS DATE), DATE'1960-01-01')) AS day_text,
            count(*) AS orders
        FROM staging_orders GROUP BY 1"""
    )


def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.date_dimension(sources_for(spark, sf_dir).feed)


def junk_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.junk_dimension(transport_labels(spark, sf_dir), layout.VISA_TYPES)


def location_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = sources_for(spark, sf_dir)
    return dimensions.location_dimension(sources.feed, sources.maps.port)


def country_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = sources_for(spark, sf_dir)
    return dimensions.country_dimension(sources.feed, sources.maps.country)


def country_dimension_unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = sources_for(spark, sf_dir)
    return dimensions.country_dimension_unknown_member(
        sources.feed, sources.maps.country_members
    )


def demographics_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = sources_for(spark, sf_dir)
    return dimensions.demographics_dimension(
        sources.feed, sources.maps.port, sources.demographics
    )


# Fact and model


def _model(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return load_model(spark, model_for(spark, sf_dir))


def fact_lookup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact without its id: five lookups, no shuffle."""
    dims = stored_dimensions(_model(spark, sf_dir))
    return fact_rows(sources_for(spark, sf_dir).feed, dims)


def fact_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fact with ids that depend on the rows alone."""
    return row_key(fact_lookup_rows(spark, sf_dir))


def codemap_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entries of the five code maps, as built and as read back from their files."""
    maps = sources_for(spark, sf_dir).maps
    folder = scratch_path(spark, "code-maps")
    export_code_maps(maps, folder, "|")
    parts = []
    for spec, built in maps.exported.items():
        schema = ", ".join(f"{name} string" for name in spec.columns)
        read = read_code_map(spark, f"{folder}/{spec.file}", schema, "|")
        for origin, df in (("built", built), ("file", read)):
            code, label, *state = spec.columns
            parts.append(
                df.select(
                    F.lit(spec.view).alias("map_name"),
                    F.col(code).alias("code"),
                    F.col(label).alias("label"),
                    (F.col(state[0]) if state else F.lit(None).cast("string")).alias("state"),
                    F.lit(origin).alias("origin"),
                )
            )
    return reduce(DataFrame.union, parts)


def _written_fact(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    stored, _ = write_fact(fact_lookup_rows(spark, sf_dir), scratch_path(spark, "fact"), **options)
    return stored


def fact_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as it is stored by year and month of arrival."""
    return _written_fact(spark, sf_dir, partitioned=True).drop("id")


def fact_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal fact rows, and how many different ids they got."""
    stored = _written_fact(spark, sf_dir)
    values = [name for name in stored.columns if name != "id"]
    return stored.groupBy(*values).agg(
        F.count(F.lit(1)).alias("fact_rows"), F.count_distinct("id").alias("fact_ids")
    )


def fact_unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of a model whose unknown countries share one member."""
    config = replace(config_for(scratch_path(spark, "members")), unknown_countries="member")
    tables, _ = build_model(spark, sources_for(spark, sf_dir), config)
    return tables[layout.FACT.view].drop("id")


def fact_role_playing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.by_origin_pair(_model(spark, sf_dir))


def fact_rejects_by_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = stored_dimensions(_model(spark, sf_dir))
    return fact_rejects(sources_for(spark, sf_dir).feed, dims)


def check_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts({name: table(spark, sf_dir, name) for name in GIVEN_TABLES})


def check_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: table(spark, sf_dir, name) for name in GIVEN_TABLES}
    return column_counts(tables, GIVEN_TABLES)


def code_length_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_mktsegment", F.col("c_custkey").cast("string").alias("c_custkey")
    )
    return code_lengths(customers, ["c_custkey", "c_mktsegment"])


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each table of the written star with its rows and repeated keys."""
    tables = _model(spark, sf_dir)
    counts = column_counts(tables, {spec.view: len(spec.columns) for spec in layout.TABLES})
    repeated = row_counts(
        {spec.view: duplicate_keys(tables[spec.view], [spec.key]) for spec in layout.TABLES}
    ).select("table_name", F.col("row_count").alias("repeated_keys"))
    return counts.join(repeated, "table_name").select(
        "table_name", "row_count", "column_count", "repeated_keys"
    )


def sql_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension and a fact given as SQL; the fact reads the stored dimension."""
    for name in ("customer", "orders"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"staging_{name}")
    specs = [
        SqlTable(
            "dim_customer",
            """SELECT monotonically_increasing_id() AS id, c_custkey, c_mktsegment
            FROM staging_customer""",
            3,
            "customer.parquet",
        ),
        SqlTable(
            "fact_orders",
            """SELECT o_orderkey, d.id AS customer_id, o_totalprice
            FROM staging_orders JOIN dim_customer d ON o_custkey = d.c_custkey""",
            3,
            "orders.parquet",
        ),
    ]
    build_sql_tables(spark, specs, scratch_path(spark, "sql-tables"))
    return spark.sql(
        """SELECT c_mktsegment, count(*) AS orders, max(o_totalprice) AS largest
        FROM fact_orders f JOIN dim_customer d ON f.customer_id = d.id GROUP BY c_mktsegment"""
    )


# Reports


def _report(report: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: report(_model(spark, sf_dir), *args)


QUERIES: dict[str, Query] = {
    "scan_parquet": scan_parquet,
    "scan_csv_dropmalformed": scan_csv_dropmalformed,
    "stage_sources": stage_sources,
    "codemap_parse": codemap_parse,
    "codemap_literal": codemap_literal,
    "codemap_csv_roundtrip": codemap_csv_roundtrip,
    "codemap_set": codemap_set,
    "split_place_label": split_place_label,
    "cluster_unknown": cluster_unknown_labels,
    "drop_nulls": drop_nulls,
    "normalize_column_names": normalize_names,
    "typed_casts": typed_casts,
    "join_case_insensitive": join_case_insensitive,
    "unique_guard_composite": unique_guard_composite,
    "unique_guard_single": unique_guard_single,
    "unique_guard_nonnull": unique_guard_nonnull_rows,
    "duplicate_key_report": duplicate_key_report,
    "union_distinct_codes": union_distinct_codes,
    "distinct_rows": distinct_rows,
    "pivot_long_to_wide": pivot_long_to_wide,
    "sas_day_to_date": sas_day_to_date,
    "sql_day_function": sql_day_function,
    "date_dimension": date_dimension,
    "junk_dimension": junk_dimension,
    "location_dimension": location_dimension,
    "country_dimension": country_dimension,
    "country_dimension_unknown_member": country_dimension_unknown_member,
    "demographics_dimension": demographics_dimension,
    "surrogate_key": surrogate_key,
    "surrogate_key_bucketed": surrogate_key_bucketed,
    "surrogate_key_copies": surrogate_key_copies,
    "fact_lookup_rows": fact_lookup_rows,
    "fact_star_join": fact_star_join,
    "fact_partitioned": fact_partitioned,
    "fact_positional": fact_positional,
    "fact_unknown_member": fact_unknown_member,
    "fact_role_playing": fact_role_playing,
    "fact_rejects_by_lookup": fact_rejects_by_lookup,
    "check_not_empty": check_not_empty,
    "check_columns": check_columns,
    "code_length_profile": code_length_profile,
    "model_roundtrip": model_roundtrip,
    "sql_tables": sql_tables,
    "report_top_locations": _report(reports.top_locations),
    "report_busiest_weekday": _report(reports.busiest_weekday, "NATION_9", 1998, 4),
    "report_top_origins": _report(reports.top_origins),
    "report_top_locations_for_origin": _report(reports.top_locations_for_origin, "NATION_7"),
    "report_origin_vs_share": _report(reports.origin_vs_share, "NATION_7"),
    "report_top_locations_by_purpose": _report(reports.top_locations_by_purpose, ["Student"]),
    "report_share_correlation": _report(
        reports.share_correlation, ["NATION_3", "NATION_7", "NATION_12", "NATION_17"]
    ),
    "report_bucket_by_location": _report(reports.bucket_by_location),
    "report_season_histogram": _report(reports.season_histogram),
    "report_by_purpose": _report(reports.by_purpose),
    "report_by_mode": _report(reports.by_mode),
    **features.QUERIES,
}
