"""Column expressions shared by the operators; all run inside the JVM."""

from starkit.functions.codes import (
    UNKNOWN_CODE,
    UNKNOWN_LABEL,
    UNKNOWN_MARKS,
    is_unknown_label,
    place_name,
    place_state,
    strip_text,
    whole_code,
)
from starkit.functions.dates import (
    CALENDAR,
    day_to_date,
    day_to_iso,
    register_day_function,
)
from starkit.functions.numbers import (
    number_to_int,
    percent,
    text_to_double,
    text_to_float,
    text_to_long,
)

__all__ = [
    "CALENDAR",
    "UNKNOWN_CODE",
    "UNKNOWN_LABEL",
    "UNKNOWN_MARKS",
    "day_to_date",
    "day_to_iso",
    "is_unknown_label",
    "number_to_int",
    "percent",
    "place_name",
    "place_state",
    "register_day_function",
    "strip_text",
    "text_to_double",
    "text_to_float",
    "text_to_long",
    "whole_code",
]
