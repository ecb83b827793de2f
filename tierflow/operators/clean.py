"""Cleaning steps over several columns of a DataFrame, one projection each."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from tierflow.functions import text


def string_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def map_columns(
    df: DataFrame, columns: Iterable[str], change: Callable[[str], str]
) -> DataFrame:
    """Put ``change`` of the named columns in their place, in a single projection."""
    chosen = set(columns)
    names = [(c, text.quoted(c)) for c in df.columns]
    if unknown := chosen.difference(df.columns):
        raise ValueError(f"no such columns: {', '.join(sorted(unknown))}")
    return df.selectExpr(*[f"{change(q)} AS {q}" if c in chosen else q for c, q in names])


def normalise_header(df: DataFrame) -> DataFrame:
    """Column names in lower case with ``_``; names that collide or vanish are an error."""
    names = [text.clean_column_name(c) for c in df.columns]
    check_header(names)
    return df.toDF(*names)


def check_header(names: list[str]) -> None:
    if not names:
        raise ValueError("the input has no columns")
    if "" in names:
        raise ValueError(f"empty column name in {names}")
    if len(set(names)) != len(names):
        raise ValueError(f"column names occur twice in {names}")


def trim_all(df: DataFrame) -> DataFrame:
    """Strip space characters from every string column."""
    return map_columns(df, string_columns(df), lambda value: f"trim({value})")


def replace_dashes(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """``--`` becomes ``0`` in the named string columns, or in all of them."""
    strings = string_columns(df)
    chosen = strings if cols is None else [c for c in cols if c in strings]
    return map_columns(df, chosen, text.placeholder_to_zero)


def blanks_to_null(df: DataFrame) -> DataFrame:
    return map_columns(df, string_columns(df), text.blank_to_null)


def safe_int(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Parse the named text columns as int, commas removed."""
    return map_columns(df, cols, text.comma_int)


def safe_float(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Parse the named text columns as float."""
    return map_columns(df, cols, text.lenient_float)
