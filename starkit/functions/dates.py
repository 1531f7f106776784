"""Day offsets and calendar attributes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from starkit.functions.numbers import number_to_int

# Fixed value: offsets count days from here.
EPOCH = "1960-01-01"


def day_to_date(offset: Column) -> Column:
    return F.date_add(F.lit(EPOCH).cast("date"), number_to_int(offset))


def day_to_iso(offset: Column) -> Column:
    """The day as ISO date-time text at midnight; null for a null offset."""
    return F.concat(day_to_date(offset).cast("string"), F.lit("T00:00:00"))


def register_day_function(spark: SparkSession) -> None:
    """Make ``get_datetime(offset)`` available in SQL; Spark inlines its body.

    Fixed value: the function's name, which users' SQL relies on.
    """
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION get_datetime(day_offset DOUBLE) RETURNS STRING
        RETURN concat(CAST(date_add(DATE'{EPOCH}', try_cast(day_offset AS INT)) AS STRING), 'T00:00:00')"""
    )


# Attribute name -> expression on a date column, in table order.
CALENDAR: dict[str, Callable[[Column], Column]] = {
    "year": F.year,
    "month": F.month,
    "dayofmonth": F.dayofmonth,
    "dayofweek": F.dayofweek,
    "dayofweek_name": lambda day: F.date_format(day, "E"),
    "dayofyear": F.dayofyear,
    "weekofyear": F.weekofyear,
    "quarter": F.quarter,
}
