"""A fact stored so that filters on any of several keys skip files.

Each key is cut into ranges that hold about equally many rows, and the bits of the range
numbers are interleaved: rows near each other on the resulting curve are near on every key.
Range partitions of the curve become files, whose statistics tell readers what to skip.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.plans.sqltables import write_counted

# Ranges of a key, as bits; their bounds are a list of this many values in the plan.
RANGE_BITS = 6
# Accuracy of the ranges' bounds: relative rank error of 1 / 10,000.
_ACCURACY = 10_000


def range_bounds(df: DataFrame, keys: list[str], bits: int = RANGE_BITS) -> dict[str, list]:
    """The values that cut each key into ``2 ** bits`` ranges of about equally many rows. They are
    estimated in one aggregate; that many values a key reach the driver, whatever the table."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(key, shares, _ACCURACY).alias(key) for key in keys]).first()
    return {key: sorted(set(found[key] or [])) for key in keys}


def range_number(key: Column, bounds: list) -> Column:
    """How many bounds are at most ``key``; null comes first."""
    if not bounds:
        return F.lit(0)
    limits = F.array(*map(F.lit, bounds))
    return F.coalesce(F.size(F.filter(limits, lambda bound: bound <= key)), F.lit(0))


def interleaved(numbers: list[Column], bits: int = RANGE_BITS) -> Column:
    """The bits of several numbers in turn, highest first."""
    if len(numbers) * bits > 62:
        raise ValueError("too many keys for the bits of a range")
    parts = [
        F.shiftleft(F.shiftright(number, bit).bitwiseAND(1).cast("bigint"), bit * len(numbers) + len(numbers) - 1 - place)
        for place, number in enumerate(numbers)
        for bit in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def clustered(df: DataFrame, keys: list[str], files: int, bits: int = RANGE_BITS) -> DataFrame:
    """The rows in ``files`` range partitions of the curve over ``keys``, sorted within.

    Equal rows of the curve are dealt on by all columns, so copies of one key or of one row do
    not have to lie in one file.
    """
    bounds = range_bounds(df, keys, bits)
    curve = interleaved([range_number(F.col(key), bounds[key]) for key in keys], bits)
    others = F.xxhash64(*df.columns, F.monotonically_increasing_id())
    marked = df.withColumn("_curve", curve).withColumn("_spread", others)
    ranged = marked.repartitionByRange(files, "_curve", "_spread")
    return ranged.sortWithinPartitions("_curve", *keys).drop("_curve", "_spread")


def write_clustered(df: DataFrame, keys: list[str], path: str, file_rows: int = 5_000_000) -> int:
    """Write the rows clustered by ``keys``, about ``file_rows`` to a file; the number of rows."""
    files = max(1, -(-df.count() // file_rows))
    return write_counted(clustered(df, keys, files), path)
