"""Column profiles that can be stored, merged and compared.

A profile has exact counts of rows and nulls, the least and greatest value and text lengths,
and two sketches: one for the number of distinct values, one for quantiles. All parts merge, so
the profile of a table that grows comes from those of its parts and not from its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# Registers of a distinct-count sketch (2 ** 12) and size of a quantile sketch.
DISTINCT_BITS, QUANTILE_SIZE = 12, 400
# Bounds of the sketches' errors: three standard errors of 1.04 / sqrt(2 ** 12), and the rank
# error that quantile sketches of this size keep with 99 %.
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.01

PROFILE = (
    "table_name string, column_name string, row_count bigint, null_count bigint, least string, "
    "greatest string, length_total bigint, numbers_least double, numbers_greatest double, "
    "distinct_sketch binary, quantile_sketch binary"
)


def _number(column: Column, kind) -> Column:
    """The value as a number on which quantiles are taken, or null: days and seconds for dates
    and times, lengths for texts."""
    if isinstance(kind, NumericType):
        return column.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(column) / 1e6
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(column.cast("timestamp")) / 1e6
    if isinstance(kind, BooleanType):
        return column.cast("int").cast("double")
    return F.char_length(column).cast("double")


def _plain(df: DataFrame) -> list[str]:
    """The columns that have an order and a text: no nested ones, no binary ones."""
    kinds = (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType, StringType)
    return [field.name for field in df.schema if isinstance(field.dataType, kinds)]


def _ends(value: str, number: str, kind) -> tuple[Column, Column]:
    """The least and greatest number. Those of the least and greatest value, where numbers keep
    the order of values, so that no further aggregate is needed; NaN is the greatest value."""
    if isinstance(kind, (StringType, TimestampNTZType)):
        return F.min(number), F.max(number)
    low, high = _number(F.min(value), kind), _number(F.max(value), kind)
    if isinstance(kind, (FloatType, DoubleType)):
        return F.when(~F.isnan(low), low), F.max(number)
    return low, high


def _measures(df: DataFrame) -> tuple[list[Column], Column]:
    """The columns that an aggregate needs, and the aggregate: an array with one struct for each
    plain column. Texts and numbers are made before it, so that its parts do not each make them."""
    plain = set(_plain(df))
    needed, structs = [], []
    for k, field in enumerate(df.schema):
        if field.name not in plain:
            continue
        column, kind = F.col(f"`{field.name}`"), field.dataType
        value, text, number = f"value_{k}", f"text_{k}", f"number_{k}"
        made = _number(column, kind)
        needed += [column.alias(value), column.cast("string").alias(text), F.when(~F.isnan(made), made).alias(number)]
        least, greatest = _ends(value, number, kind)
        structs.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.count(F.lit(1)).alias("row_count"),
                (F.count(F.lit(1)) - F.count(value)).alias("null_count"),
                F.min(value).cast("string").alias("least"),
                F.max(value).cast("string").alias("greatest"),
                F.coalesce(F.sum(F.char_length(text)), F.lit(0)).cast("bigint").alias("length_total"),
                least.alias("numbers_least"),
                greatest.alias("numbers_greatest"),
                F.hll_sketch_agg(text, F.lit(DISTINCT_BITS)).alias("distinct_sketch"),
                F.kll_sketch_agg_double(number, F.lit(QUANTILE_SIZE)).alias("quantile_sketch"),
            )
        )
    return needed, F.array(*structs).alias("structs")


def _rows(found: DataFrame, name: str) -> DataFrame:
    rows = found.select(F.inline("structs"))
    return rows.select(F.lit(name).alias("table_name"), *rows.columns)


def profile(df: DataFrame, name: str) -> DataFrame:
    """One row of ``PROFILE`` for each plain column, from one scan and one aggregate.

    ``least`` and ``greatest`` are texts of the values in the column's own order. NaN is no
    number of the quantiles. A table without rows gives counts of 0 and empty sketches.
    """
    needed, structs = _measures(df)
    if not needed:
        return df.sparkSession.createDataFrame([], PROFILE)
    return _rows(df.select(*needed).agg(structs), name)


def profile_parts(df: DataFrame, name: str, part: Column) -> DataFrame:
    """The profiles of a table's parts, one part for each value of ``part``, from one scan and
    one aggregate; and that of no rows, which a table without rows has alone."""
    needed, structs = _measures(df)
    if not needed:
        return df.sparkSession.createDataFrame([], PROFILE)
    rows = df.select(part.alias("part"), *needed)
    found = rows.groupBy("part").agg(structs).select("structs")
    return _rows(found.union(rows.limit(0).agg(structs)), name)


def merged(profiles: DataFrame) -> DataFrame:
    """One profile for each table and column of several. Text order decides ``least`` and
    ``greatest`` where values are no numbers, and the order of numbers where they are."""
    numeric = F.col("numbers_least").isNotNull() & F.col("least").try_cast("double").isNotNull()
    low = F.when(numeric, F.col("numbers_least"))
    high = F.when(numeric, F.col("numbers_greatest"))
    return profiles.groupBy("table_name", "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.min_by("least", F.struct(F.col("least").isNull(), low, "least")).alias("least"),
        F.max_by("greatest", F.struct(F.col("greatest").isNotNull(), high, "greatest")).alias("greatest"),
        F.sum("length_total").alias("length_total"),
        F.min("numbers_least").alias("numbers_least"),
        F.max("numbers_greatest").alias("numbers_greatest"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch", F.lit(QUANTILE_SIZE)).alias("quantile_sketch"),
    )


def described(profiles: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Profiles with ``null_share``, ``mean_length``, ``distinct_estimate`` and an array of
    ``quantiles``, null without numbers, in place of sketches."""
    values = F.col("row_count") - F.col("null_count")
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    found = F.when(
        F.col("numbers_least").isNotNull(), F.kll_sketch_get_quantile_double("quantile_sketch", wanted)
    )
    return profiles.select(
        "table_name",
        "column_name",
        "row_count",
        "null_count",
        F.try_divide("null_count", "row_count").alias("null_share"),
        "least",
        "greatest",
        F.try_divide("length_total", values).alias("mean_length"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"),
        found.alias("quantiles"),
    )


# What may change from one state of a column to the next without being named.
NULL_CHANGE, DISTINCT_CHANGE, RANK_CHANGE = 0.05, 0.5, 0.1
# Steps between the quantiles at which two distributions are compared.
_STEPS = 50


def drift(
    before: DataFrame,
    after: DataFrame,
    null_change: float = NULL_CHANGE,
    distinct_change: float = DISTINCT_CHANGE,
    rank_change: float = RANK_CHANGE,
) -> DataFrame:
    """``(table_name, column_name, findings array<string>)`` of columns that changed.

    ``missing`` and ``new`` columns; ``nulls``: their share changed by more than ``null_change``;
    ``distinct``: the number of distinct values for each row with one, by more than this factor;
    ``range``: numbers beyond the earlier least or greatest one; ``distribution``: some earlier
    quantile has another rank now, by more than ``rank_change`` and both sketches' errors.
    """
    key = ["table_name", "column_name"]
    old, new = (
        profiles.select(*key, F.struct(*[c for c in profiles.columns if c not in key]).alias(side))
        for profiles, side in ((before, "old"), (after, "new"))
    )
    both = old.join(new, key, "full_outer")

    def share(side: str, part: str) -> Column:
        return F.coalesce(F.try_divide(F.col(f"{side}.{part}"), F.col(f"{side}.row_count")), F.lit(0.0))

    def variety(side: str) -> Column:
        values = F.col(f"{side}.row_count") - F.col(f"{side}.null_count")
        return F.try_divide(F.hll_sketch_estimate(f"{side}.distinct_sketch"), values)

    ratio = F.try_divide(variety("new"), variety("old"))
    numbers = F.col("old.numbers_least").isNotNull() & F.col("new.numbers_least").isNotNull()
    steps = F.array(*[F.lit(k / _STEPS) for k in range(_STEPS + 1)])
    grids = [F.kll_sketch_get_quantile_double(f"{side}.quantile_sketch", steps) for side in ("old", "new")]

    def rank(grid: Column, value: Column) -> Column:
        return F.size(F.filter(grid, lambda one: one <= value)) / _STEPS

    moved = F.exists(
        grids[0], lambda value: F.abs(rank(grids[0], value) - rank(grids[1], value)) > rank_change + 2 * RANK_ERROR
    )
    beyond = (F.col("new.numbers_least") < F.col("old.numbers_least")) | (
        F.col("new.numbers_greatest") > F.col("old.numbers_greatest")
    )
    present = F.col("old").isNotNull() & F.col("new").isNotNull()
    findings = [
        F.when(F.col("new").isNull(), "missing"),
        F.when(F.col("old").isNull(), "new"),
        F.when(present & (F.abs(share("new", "null_count") - share("old", "null_count")) > null_change), "nulls"),
        F.when(present & ((ratio > 1 + distinct_change) | (ratio < 1 / (1 + distinct_change))), "distinct"),
        F.when(present & numbers & beyond, "range"),
        F.when(present & numbers & moved, "distribution"),
    ]
    named = both.select(*key, F.array_compact(F.array(*findings)).alias("findings"))
    return named.filter(F.size("findings") > 0)


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """The profiles of several tables."""
    return reduce(DataFrame.union, [profile(df, name) for name, df in tables.items()])
