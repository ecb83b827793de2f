"""Aggregations per key. Every one combines on the map side before its shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.specs import RollupSpec


def rollup(
    df: DataFrame, spec: RollupSpec, key: str = "player_id", year: str = "year"
) -> DataFrame:
    """Sums of the spec's columns (NULL counts as 0) and the number of distinct years."""
    sums = [f"sum(coalesce({column}, 0)) AS {out}" for out, column in spec.sums.items()]
    return df.groupBy(F.expr(f"CAST({key} AS int) AS {key}")).agg(
        *map(F.expr, [*sums, f"count(DISTINCT {year}) AS years"])
    )


def union_columns(tables: Iterable[DataFrame], columns: Iterable[str]) -> DataFrame:
    """Bag union of the named columns of several tables."""
    columns = list(columns)
    return reduce(DataFrame.unionByName, [t.select(*columns) for t in tables])


def year_span(
    tables: Iterable[DataFrame], key: str = "player_id", year: str = "year"
) -> DataFrame:
    """First and last year per key, in text order."""
    years = union_columns(tables, [key, year])
    return years.groupBy(key).agg(
        F.expr(f"CAST(min({year}) AS string) AS y_min"),
        F.expr(f"CAST(max({year}) AS string) AS y_max"),
    )


def pair_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows per (key, value); NULL is a value of its own."""
    return df.groupBy(key, value).agg(F.expr("count(*) AS cnt"))


def max_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(value).alias(value))


def distinct_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*columns).distinct()


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name ``vw`` and row count ``c``."""
    counts = [t.selectExpr(f"'{name}' AS vw", "count(*) AS c") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)
