"""Lost feed rows, kept with the reasons for which they are no fact rows.

One pass over the feed gives fact rows and lost rows; both are written by one job, as two
partitions of a table. A lost row is whole, so it can be looked at, counted by reason, and
tried again when the dimensions have grown.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starkit.operators.checks import require_columns
from starkit.operators.keys import positional_key
from starkit.operators.lookup import REASONS, reason_names
from starkit.plans import layout
from starkit.plans.fact import FEED_ROW, Dimensions, fact_lookups, fact_split

_REJECTED = "rejected"


@dataclass(frozen=True)
class SplitCounts:
    """Rows of a written split, and the first id that it leaves free."""

    fact_rows: int
    rejected_rows: int
    next_id: int


def write_split(
    split: DataFrame, folder: str, first_id: int = 0, name: str = layout.SPLIT
) -> SplitCounts:
    """Write the rows of ``fact_split``, fact ids counting from ``first_id``. They are counted,
    and the largest id is found, while they are written."""
    facts = split.withColumn(_REJECTED, F.col(REASONS) != 0)
    numbered = positional_key(facts, "_position").withColumn("_id", F.col("_position") + first_id)
    numbered = numbered.select(F.col("_id").alias("id"), *facts.columns)
    require_columns(numbered.select(*layout.FACT.columns), layout.FACT.view, layout.FACT.schema)
    seen = Observation()
    observed = numbered.observe(
        seen,
        F.count_if(~F.col(_REJECTED)).alias("facts"),
        F.count_if(_REJECTED).alias("rejects"),
        F.max("id").alias("last"),
    )
    observed.write.partitionBy(_REJECTED).parquet(f"{folder}/{name}")
    found = seen.get
    last = first_id - 1 if found["last"] is None else found["last"]
    return SplitCounts(found["facts"], found["rejects"], last + 1)


def read_rejects(spark: SparkSession, paths: list[str], feed: DataFrame) -> DataFrame:
    """Lost rows ``(columns of the feed..., reject_reasons)`` of written splits; ``feed`` names
    the columns and may be empty."""
    columns = ", ".join(f"`{name}`: {kind}" for name, kind in feed.dtypes)
    schema = f"{FEED_ROW} struct<{columns}>, {REASONS} int"
    if not paths:
        return spark.createDataFrame([], schema).select(f"{FEED_ROW}.*", REASONS)
    return spark.read.schema(schema).parquet(*paths).select(f"{FEED_ROW}.*", REASONS)


def explained(rejects: DataFrame, dims: Dimensions) -> DataFrame:
    """Lost rows with the names of the lookups that lost them, as ``reasons``."""
    return rejects.withColumn("reasons", reason_names(fact_lookups(dims), F.col(REASONS)))


def split_feed(feed: DataFrame, dims: Dimensions, verify: bool = True) -> DataFrame:
    """``fact_split`` of the columns that the fact and its lookups use."""
    return fact_split(feed.select(*layout.USED_COLUMNS), dims, verify)
