"""Expressions on codes and their labels."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels holding one of these marks stand for an unknown member.
UNKNOWN_MARKS = ("collapsed", "invalid", "no country code")
UNKNOWN_LABEL = "Unknown Country"
UNKNOWN_CODE = 9999


def strip_text(col: Column) -> Column:
    """Trim every kind of white space; Spark's own trim removes spaces only."""
    return F.regexp_replace(F.regexp_replace(col, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def is_unknown_label(label: Column) -> Column:
    lowered = F.lower(label)
    return reduce(or_, [lowered.contains(mark) for mark in UNKNOWN_MARKS])


def whole_code(col: Column) -> Column:
    """A numeric code as int, null for anything that is not a whole number.

    ``135.0`` is code 135 while ``135.5`` equals no integer code; a plain cast
    would turn it into one.
    """
    number = col.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def _place_parts(label: Column) -> Column:
    return F.split(label, ",", -1)


def place_name(label: Column) -> Column:
    """``NAME`` of a ``NAME, STATE`` label; null unless there are exactly two parts."""
    parts = _place_parts(label)
    return F.when(F.size(parts) == 2, parts[0])


def place_state(label: Column) -> Column:
    """``STATE`` of a ``NAME, STATE`` label; null unless there are exactly two parts."""
    parts = _place_parts(label)
    return F.when(F.size(parts) == 2, F.trim(parts[1]))
