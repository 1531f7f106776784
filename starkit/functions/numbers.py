"""Tolerant numbers from text: bad input gives null, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _whole_part(text: Column) -> Column:
    """Drop a decimal fraction; ANSI casts reject ``12.7`` as an integer."""
    return F.regexp_replace(text, r"\.\d*\s*$", "")


def number_to_int(number: Column) -> Column:
    """A number, or its text, cut to int."""
    return number.try_cast("double").try_cast("int")


def text_to_long(text: Column) -> Column:
    return _whole_part(text).try_cast("bigint")


def text_to_float(text: Column) -> Column:
    return text.try_cast("float")


def text_to_double(text: Column) -> Column:
    return text.try_cast("double")


def percent(part: Column, whole: Column) -> Column:
    """``part`` in per cent of ``whole``; null when ``whole`` is zero or null."""
    return F.try_divide(part, whole) * 100
