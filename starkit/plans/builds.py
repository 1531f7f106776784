"""The log of builds under a target.

A build writes into a folder of its own. One row appended to the log makes it what readers
see; until then nothing of an earlier build is touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.operators.checks import CheckFailed
from starkit.plans import layout


# Kinds of builds that are models; others may share a target's log.
FULL, INCREMENTAL, COMPACTED = "full", "incremental", "compacted"
MODELS = (FULL, INCREMENTAL, COMPACTED)


@dataclass(frozen=True)
class Published:
    """An entry of a target's log of builds."""

    number: int
    build: str
    kind: str
    fact_parts: tuple[str, ...]  # folders of the fact, under the target
    reject_parts: tuple[str, ...] = ()  # folders of kept lost feed rows


_LOG = (
    "build string, published_at timestamp, number bigint, kind string, "
    "fact_parts array<string>, reject_parts array<string>"
)


def _log(spark: SparkSession, target: str) -> DataFrame:
    """Entries in the order of their numbers; those of older versions have none."""
    log = spark.read.schema(_LOG).parquet(f"{target}/{layout.PUBLISHED}")
    default = F.array(F.concat("build", F.lit(f"/{layout.FACT.directory}")))
    return log.select(
        F.struct(F.coalesce("number", F.lit(0)).alias("number"), "published_at", "build").alias("place"),
        F.coalesce("kind", F.lit(FULL)).alias("kind"),
        F.coalesce("fact_parts", default).alias("fact_parts"),
        F.coalesce("reject_parts", F.array().cast("array<string>")).alias("reject_parts"),
    )


def published(spark: SparkSession, target: str, *kinds: str) -> list[Published]:
    """The entries of a target's log, the latest first; of some kinds only, if given. One row
    a build, so a log of years is some thousand rows."""
    try:
        log = _log(spark, target)
    except AnalysisException:  # nothing was ever published
        return []
    if kinds:
        log = log.filter(F.col("kind").isin(*kinds))
    return [
        Published(
            row["place"]["number"],
            row["place"]["build"],
            row["kind"],
            tuple(row["fact_parts"]),
            tuple(row["reject_parts"]),
        )
        for row in log.orderBy(F.desc("place")).collect()
    ]


def publish(
    spark: SparkSession,
    target: str,
    build: str,
    kind: str = FULL,
    fact_parts: tuple[str, ...] | None = None,
    reject_parts: tuple[str, ...] = (),
) -> None:
    """Make a completed build the model. A file of one row appears as a whole. It is numbered
    after what is there, so that clocks of different machines do not matter."""
    earlier = published(spark, target)
    parts = (f"{build}/{layout.FACT.directory}",) if fact_parts is None else fact_parts
    entry = spark.range(1).select(
        F.lit(build).alias("build"),
        F.current_timestamp().alias("published_at"),
        F.lit(earlier[0].number + 1 if earlier else 1).cast("bigint").alias("number"),
        F.lit(kind).alias("kind"),
        F.array(*map(F.lit, parts)).cast("array<string>").alias("fact_parts"),
        F.array(*map(F.lit, reject_parts)).cast("array<string>").alias("reject_parts"),
    )
    entry.write.mode("append").parquet(f"{target}/{layout.PUBLISHED}")


def current_build(spark: SparkSession, target: str) -> Published:
    """The model that was published last."""
    entries = published(spark, target, *MODELS)
    if not entries:
        raise CheckFailed(f"{target}: no build was published")
    return entries[0]


def current_folder(spark: SparkSession, target: str) -> str:
    """The folder of the model that was published last."""
    return f"{target}/{current_build(spark, target).build}"
