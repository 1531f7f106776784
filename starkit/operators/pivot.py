"""Long to wide in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_sum(
    df: DataFrame, pivot_column: str, value: Column, names: dict[str, str], value_column: str
) -> DataFrame:
    """Sum ``value`` into one column per listed pivot value.

    Groups by every column except ``pivot_column`` and ``value_column``. A group
    with only unlisted pivot values stays, with nulls. Conditional sums need one
    shuffle where ``GroupedData.pivot`` takes two.
    """
    keys = [c for c in df.columns if c not in (pivot_column, value_column)]
    sums = [
        F.sum(F.when(F.col(f"`{pivot_column}`") == wanted, value)).alias(name)
        for wanted, name in names.items()
    ]
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*sums)
