"""Stand-in sources for the star, derived from the test tables by Spark.

A visit is a line item: its supplier's nation is the port and the residence, its
customer's nation the citizenship, its ship date the arrival. Some ports are unknown,
some modes are missing, some ports have no city, and some cities have two profiles, so
that every lookup loses rows and the fact fans out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.functions.dates import EPOCH
from starkit.plans import layout
from starkit.plans.model import BuildConfig, Sources, build_model, stage_sources
from starkit.session import scratch_path

# Customer segments stand in for the population groups.
SEGMENT_GROUPS = {
    "AUTOMOBILE": "Hispanic or Latino",
    "BUILDING": "White",
    "FURNITURE": "Black or African-American",
    "HOUSEHOLD": "American Indian and Alaska Native",
    "MACHINERY": "Asian",
}
UNKNOWN_PORT = "ZZZ"
DEMOGRAPHICS_SCHEMA = ", ".join(
    f"`{name}` string"
    for name in (
        "City", "State", "Median Age", "Male Population", "Female Population",
        "Total Population", "Number of Veterans", "Foreign-born",
        "Average Household Size", "State Code", "Race", "Count",
    )
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str):
    return F.col(column).cast("string")


def visit_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    ship_day = F.col("l_shipdate").cast("date")
    # Orders find their customers first, so that the lines are dealt only once.
    placed = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(home, F.col("c_nationkey") == F.col("n_nationkey"))
        .drop("o_custkey", "c_custkey", "n_nationkey")
    )
    return (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.when((F.col("l_linenumber") == 6) & (F.col("l_quantity") > 40), UNKNOWN_PORT)
            .otherwise(_text("s_nationkey"))
            .alias(layout.PORT),
            _text("n_regionkey").alias(layout.STATE),
            F.col("c_nationkey").cast("double").alias(layout.CITIZENSHIP),
            F.col("s_nationkey").cast("double").alias(layout.RESIDENCE),
            F.datediff(ship_day, F.lit(EPOCH).cast("date")).cast("double").alias(layout.ARRIVAL_DAY),
            F.when(F.col("l_returnflag") == "A", 1.0)
            .when(F.col("l_returnflag") == "N", 2.0)
            .otherwise(3.0)
            .alias(layout.VISA),
            F.when(F.col("l_linenumber") == 7, None)
            .when(F.col("l_linestatus") == "F", 1.0)
            .otherwise(2.0)
            .alias(layout.TRANSPORT),
            F.col("l_quantity").alias(layout.AGE),
            (F.year(ship_day) - F.col("l_quantity")).alias(layout.BIRTH_YEAR),
            F.col("o_orderpriority").alias(layout.GENDER),
            _text("l_linenumber").alias(layout.AIRLINE),
        )
    )


def city_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation and customer segment, all columns as text.

    One nation in twelve has no row; in one of nine, a group has a median age of its own.
    """
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    whole = customers.groupBy("c_nationkey").agg(
        F.count_if(F.col("c_custkey") % 2 == 0).alias("even"),
        F.count_if(F.col("c_custkey") % 2 == 1).alias("odd"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("c_acctbal") < 0).alias("overdrawn"),
        F.count_if(F.col("c_acctbal") > 5000).alias("wealthy"),
    )
    group = reduce(
        lambda chain, pair: chain.when(F.col("c_mktsegment") == pair[0], pair[1]),
        SEGMENT_GROUPS.items(),
        F,
    )
    segments = (
        customers.filter(F.col("c_nationkey") % 12 != 11)
        .groupBy("c_nationkey", group.alias("Race"))
        .agg(F.count(F.lit(1)).cast("string").alias("Count"))
    )
    apart = (F.col("n_nationkey") % 9 == 4) & (F.col("Race") == "Asian")
    age_part = F.when(apart, ".7").otherwise(".5")
    return (
        segments.join(whole, "c_nationkey")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.initcap("n_name").alias("City"),
            F.col("r_name").alias("State"),
            F.concat((F.col("n_nationkey") + 20).cast("string"), age_part).alias("Median Age"),
            _text("even").alias("Male Population"),
            _text("odd").alias("Female Population"),
            _text("total").alias("Total Population"),
            _text("overdrawn").alias("Number of Veterans"),
            _text("wealthy").alias("Foreign-born"),
            F.concat(F.lit("2."), (F.col("n_nationkey") % 10).cast("string")).alias(
                "Average Household Size"
            ),
            _text("n_regionkey").alias("State Code"),
            "Race",
            "Count",
        )
    )


def transport_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transport map behind the line statuses that occur."""
    statuses = table(spark, sf_dir, "lineitem").select("l_linestatus").distinct()
    sea = F.col("l_linestatus") != "F"
    return statuses.select(
        F.when(sea, "2").otherwise("1").alias("transport_code"),
        F.when(sea, "Sea").otherwise("Air").alias("transport_type"),
    )


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines ``(section, seq, line)`` of a label text for the nations."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    key = _text("n_nationkey")
    unknown = F.col("n_name").startswith("NATION_2")
    country = F.when(unknown, F.concat(F.lit("INVALID: "), "n_name")).otherwise(F.col("n_name"))
    place = F.concat("n_name", F.lit(", "), _text("n_regionkey"))
    entries = {
        layout.COUNTRY_SECTION: nations.select(key.alias("code"), country.alias("label")),
        layout.PORT_SECTION: nations.select(key.alias("code"), place.alias("label")),
        layout.TRANSPORT_SECTION: transport_labels(spark, sf_dir).toDF("code", "label"),
        layout.STATE_SECTION: regions.select(_text("r_regionkey"), "r_name").toDF("code", "label"),
    }
    parts = []
    for number, (section, codes) in enumerate(entries.items()):
        line = F.concat(F.lit("\t'"), "code", F.lit("'\t=\t'"), "label", F.lit("'"))
        frame = F.array(
            F.struct(F.lit(0).alias("seq"), F.lit(f"value {section}").alias("line")),
            F.struct(F.lit(2).alias("seq"), F.lit(";").alias("line")),
        )
        parts.append(codes.select(F.lit(number).alias("section"), F.lit(1).alias("seq"), line.alias("line")))
        parts.append(spark.range(1).select(F.lit(number).alias("section"), F.inline(frame)))
    return reduce(DataFrame.union, parts)


_sources: dict[tuple[str, str], Sources] = {}
_models: dict[tuple[str, str], str] = {}


def _cache_key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, sf_dir


def config_for(root: str) -> BuildConfig:
    return BuildConfig(
        feed_path=f"{root}/feed",
        demographics_path=f"{root}/demographics",
        labels_path=f"{root}/labels",
        target=f"{root}/model",
        feed_columns=11,
        demographics_schema=DEMOGRAPHICS_SCHEMA,
        export_maps=False,
    )


def write_sources(spark: SparkSession, sf_dir: str, delivery: Column | None = None) -> BuildConfig:
    """Write the three sources in the formats a user of the toolkit would bring; the feed in
    folders ``delivery=...``, if the rows have one."""
    config = config_for(scratch_path(spark, "visits"))
    feed = visit_feed(spark, sf_dir)
    if delivery is None:
        feed.write.parquet(config.feed_path)
    else:
        feed.withColumn("delivery", delivery).write.partitionBy("delivery").parquet(config.feed_path)
    city_rows(spark, sf_dir).write.option("header", True).option("sep", ";").csv(
        config.demographics_path
    )
    # One dictionary of a few dozen lines: a single file by its nature.
    label_lines(spark, sf_dir).coalesce(1).sortWithinPartitions("section", "seq").select(
        "line"
    ).write.text(config.labels_path)
    return config


def sources_for(spark: SparkSession, sf_dir: str) -> Sources:
    """The staged sources, written once per application and data folder."""
    key = _cache_key(spark, sf_dir)
    if key not in _sources:
        config = write_sources(spark, sf_dir)
        _sources[key], _ = stage_sources(spark, config)
    return _sources[key]


def model_for(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the written star, built once per application and data folder."""
    key = _cache_key(spark, sf_dir)
    if key not in _models:
        config = config_for(scratch_path(spark, "star"))
        build_model(spark, sources_for(spark, sf_dir), config)
        _models[key] = config.target
    return _models[key]
