"""Surrogate keys.

``positional_key``  no shuffle; fixed once the table is written.
``dense_key``       1..N in the order of a unique natural key; stores its input once.
``row_key``         unique, a function of the rows alone; for large tables.
``dense_row_key``   1..N, a function of the rows alone; for large tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkit.session import scratch_path

_SLOT = "_slot"
_PART = "_part"
_OFFSET = "_offset"
_COPIES = "_copies"
_FIRST = "_first_copy"
_SPAN = "_span"
_BUCKET = "_bucket"
_BASE = "_base"

# monotonically_increasing_id(): partition number above 33 bits of position.
_POSITION_BITS = 33

ROW_KEY_BUCKETS = 1 << 20
ROW_KEY_BITS = 40
DENSE_BUCKETS = 1 << 16
# The totals of all buckets are broadcast: about 24 bytes each.
MOST_DENSE_BUCKETS = 16**5
COPY_SPAN = 100_000


def positional_key(df: DataFrame, name: str = "id") -> DataFrame:
    """Number rows by task and position, for a table about to be written.

    Task numbers keep the ids apart and a write commits one attempt per task, so
    the stored ids are unique whatever was retried. Read them back from the
    written table; evaluating the plan again may number differently.
    """
    return df.select(F.monotonically_increasing_id().alias(name), *df.columns)


def dense_key(df: DataFrame, order_by: list[str], name: str = "id") -> DataFrame:
    """Number rows 1..N in the order of ``order_by``, which must be unique.

    Rows are range partitioned and sorted, then stored with their position, so both
    reads below see the same placement, and the one that counts reads positions only.
    Only one count per partition is summed up in one place.
    """
    spark = df.sparkSession
    ranged = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(_SLOT, F.monotonically_increasing_id())
    )
    path = scratch_path(spark, "dense-key")
    ranged.write.parquet(path)
    placed = spark.read.schema(ranged.schema).parquet(path).withColumn(
        _PART, F.shiftright(_SLOT, _POSITION_BITS)
    )
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(_PART)
        .agg(F.count(F.lit(1)).alias(_COPIES))
        .select(_PART, F.coalesce(F.sum(_COPIES).over(before), F.lit(0)).alias(_OFFSET))
    )
    position = F.col(_SLOT).bitwiseAND((1 << _POSITION_BITS) - 1)
    # One row per partition, so the broadcast side is bounded by the shuffle setting.
    return placed.join(F.broadcast(offsets), _PART).select(
        (F.col(_OFFSET) + position + 1).alias(name), *df.columns
    )


def hash_bucket(columns: list[str], buckets: int) -> Column:
    """A bucket number below ``buckets``, a power of 16, from the columns' text.

    MD5 rather than Spark's own hash, so that other engines can reproduce it.
    """
    digits = (buckets.bit_length() - 1) // 4
    if buckets != 16**digits:
        raise ValueError(f"buckets must be a power of 16, not {buckets}")
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def _placed_copies(
    df: DataFrame, bucket_on: list[str] | None, buckets: int, copy_span: int
) -> DataFrame:
    """Distinct rows with a count of copies and their start within a hash bucket.

    Equal rows are counted before any bucket is formed, and a long run of copies
    is cut into spans with buckets of their own: no bucket depends on how often
    a row or a key repeats.
    """
    spans = F.sequence(F.lit(0).cast("bigint"), F.col(_COPIES) - 1, F.lit(copy_span).cast("bigint"))
    runs = (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias(_COPIES))
        .withColumn(_FIRST, F.explode(spans))
        .withColumn(_SPAN, F.least(F.lit(copy_span).cast("bigint"), F.col(_COPIES) - F.col(_FIRST)))
        .withColumn(_BUCKET, hash_bucket([*(bucket_on or df.columns), _FIRST], buckets))
        .select(*df.columns, _FIRST, _SPAN, _BUCKET)
    )
    earlier = (
        Window.partitionBy(_BUCKET)
        .orderBy(*df.columns, _FIRST)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return runs.withColumn(_BASE, F.coalesce(F.sum(_SPAN).over(earlier), F.lit(0)))


def _expand(runs: DataFrame, start: Column, columns: list[str], name: str) -> DataFrame:
    """One row per copy, numbered from ``start``."""
    return runs.select(
        F.explode(F.sequence(start, start + F.col(_SPAN) - 1)).alias(name), *columns
    )


def row_key(
    df: DataFrame,
    name: str = "id",
    bucket_on: list[str] | None = None,
    copy_span: int = COPY_SPAN,
) -> DataFrame:
    """A unique id per row: hash bucket in the high bits, position below.

    The same rows get the same ids however they are stored or partitioned. Equal
    rows are interchangeable. ``bucket_on`` names the columns to hash (default
    all); together they should nearly identify a row.
    """
    runs = _placed_copies(df, bucket_on, ROW_KEY_BUCKETS, copy_span)
    start = F.shiftleft(_BUCKET, ROW_KEY_BITS) + F.col(_BASE)
    return _expand(runs, start, df.columns, name)


def dense_row_key(
    df: DataFrame,
    name: str = "id",
    bucket_on: list[str] | None = None,
    buckets: int = DENSE_BUCKETS,
    copy_span: int = COPY_SPAN,
) -> DataFrame:
    """Number rows 1..N in the order (hash bucket, columns).

    Costs one more pass than ``row_key``: bucket totals are summed up, at most
    one row per bucket, and broadcast back.
    """
    if buckets > MOST_DENSE_BUCKETS:
        raise ValueError(f"buckets must be at most {MOST_DENSE_BUCKETS}, not {buckets}")
    runs = _placed_copies(df, bucket_on, buckets, copy_span)
    before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        runs.groupBy(_BUCKET)
        .agg(F.sum(_SPAN).alias(_COPIES))
        .select(_BUCKET, F.coalesce(F.sum(_COPIES).over(before), F.lit(0)).alias(_OFFSET))
    )
    joined = runs.join(F.broadcast(offsets), _BUCKET)
    return _expand(joined, F.col(_OFFSET) + F.col(_BASE) + 1, df.columns, name)


def smart_key(major: Column, minor: Column) -> Column:
    """``major + 100`` followed by ``minor``: (1, 2) becomes 1012."""
    return F.concat((major + 100).cast("string"), minor.cast("string")).cast("int")
