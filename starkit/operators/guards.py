"""Key uniqueness, in aggregate form.

Counting per key with ``groupBy`` combines on the map side, so a key that holds
a large share of the rows costs one partial row per task. A window over the key
would sort all those rows in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_COUNT = "_key_rows"


def unique_guard(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs once; every row of a repeated key is removed."""
    payload = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(_COUNT), *[F.any_value(c).alias(c) for c in payload])
        .where(F.col(_COUNT) == 1)
        .select(*df.columns)
    )


def unique_guard_nonnull(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Rows whose key has exactly one non-null ``column``; its null rows stay too.

    Window partitions treat null keys as equal, so the join does as well. Its
    null-safe keys also give both sides a shuffle of their own; a join straight on
    the aggregate's partitioning is one that adaptive execution cannot split when
    ``df`` has a hot key.
    """
    key_names = [f"_guard_{k}" for k in keys]
    passing = (
        df.groupBy(*keys)
        .agg(F.count(column).alias(_COUNT))
        .where(F.col(_COUNT) == 1)
        .select(*[F.col(k).alias(n) for k, n in zip(keys, key_names)])
    )
    match = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, key_names)]
    return df.join(passing, match, "left_semi")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each repeated key with its number of rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("key_rows"))
        .where(F.col("key_rows") > 1)
    )
