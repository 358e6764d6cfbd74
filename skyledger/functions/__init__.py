"""Column expressions shared by the operators."""

from skyledger.functions.casts import (
    to_bool,
    to_date,
    to_double,
    to_float,
    to_int,
    to_long,
    whole_minutes,
)
from skyledger.functions.dates import date_parts, lead_days
from skyledger.functions.text import (
    clean_path,
    extract_select,
    lookup_key,
    not_blank,
    strip,
    unquote,
)

__all__ = [
    "clean_path",
    "date_parts",
    "extract_select",
    "lead_days",
    "lookup_key",
    "not_blank",
    "strip",
    "to_bool",
    "to_date",
    "to_double",
    "to_float",
    "to_int",
    "to_long",
    "unquote",
    "whole_minutes",
]
