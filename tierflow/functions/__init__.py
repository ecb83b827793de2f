"""Text parsing as SQL expressions."""

from tierflow.functions.text import (
    blank_to_null,
    clean_column_name,
    comma_int,
    digits_int,
    extract_key,
    has_pair,
    lenient_float,
    lenient_int,
    marker_int,
    normalise,
    parse_date,
    placeholder_to_zero,
    quoted,
    split_pair,
)

__all__ = [
    "blank_to_null",
    "clean_column_name",
    "comma_int",
    "digits_int",
    "extract_key",
    "has_pair",
    "lenient_float",
    "lenient_int",
    "marker_int",
    "normalise",
    "parse_date",
    "placeholder_to_zero",
    "quoted",
    "split_pair",
]
