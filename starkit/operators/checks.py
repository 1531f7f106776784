"""Table checks. Every failed check raises."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.operators.guards import duplicate_keys


class CheckFailed(Exception):
    """A table does not meet its contract."""


def require_not_empty(df: DataFrame, name: str) -> None:
    if df.isEmpty():
        raise CheckFailed(f"{name}: no rows")


def require_columns(df: DataFrame, name: str, expected: int | list[str] | dict[str, str]) -> None:
    """Check the number of columns, their names in order, or names and types."""
    if isinstance(expected, int):
        found = len(df.columns)
    elif isinstance(expected, list):
        found = df.columns
    else:
        found, expected = list(df.dtypes), list(expected.items())
    if found != expected:
        raise CheckFailed(f"{name}: expected columns {expected}, found {found}")


def require_unique(df: DataFrame, name: str, keys: list[str]) -> None:
    if not duplicate_keys(df, keys).isEmpty():
        raise CheckFailed(f"{name}: key {keys} is not unique")


def require_keys(df: DataFrame, name: str, keys: list[str]) -> None:
    """Every row has all of its key."""
    if not df.filter(reduce(or_, [F.col(key).isNull() for key in keys])).isEmpty():
        raise CheckFailed(f"{name}: key {keys} is null")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row ``(table_name, row_count, passed)`` per table; empty tables fail."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            (F.col("row_count") > 0).alias("passed"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, counts)


def column_counts(tables: dict[str, DataFrame], expected: dict[str, int]) -> DataFrame:
    """One row ``(table_name, column_count, row_count, passed)`` per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            F.lit(len(df.columns)).alias("column_count"),
            "row_count",
            F.lit(len(df.columns) == expected[name]).alias("passed"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, counts)


def code_lengths(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct combinations of text lengths in ``columns``."""
    return df.select(*[F.length(c).alias(f"{c}_length") for c in columns]).distinct()
