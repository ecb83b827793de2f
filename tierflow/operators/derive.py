"""Attributes derived from rolled-up rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.operators.join import SALTS, salted_left_join
from tierflow.operators.rollup import pair_counts

_BLOCK = 4096


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Each row as often as its ``copies`` column says; the column is dropped.

    Copies are made in blocks, so that no array grows with the count.
    """
    blocks = f"explode(sequence(1L, ceil({copies} / {_BLOCK}))) AS _block"
    inner = f"explode(sequence(1L, least({_BLOCK}, {copies} - (_block - 1) * {_BLOCK}))) AS _copy"
    kept = [c for c in df.columns if c != copies]
    return (
        df.filter(f"{copies} > 0").selectExpr("*", blocks).selectExpr(*kept, inner).select(*kept)
    )


def count_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with their number in ``copies``; the inverse of ``repeat_rows``."""
    return df.groupBy(*df.columns).agg(F.expr("count(*) AS copies"))


def merge_copies(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Distinct rows, their ``copies`` summed."""
    others = [c for c in df.columns if c != copies]
    return df.groupBy(*others).agg(F.sum(copies).alias(copies))


def modal_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key: its most frequent value, and ``n_values`` distinct values.

    Ties go to the smaller value, NULL first. Two aggregations, both combined before
    their shuffle; no window gathers the values of a key.
    """
    best = f"min(named_struct('rank', -cnt, 'value', {value})) AS best"
    return (
        pair_counts(df, key, value)
        .groupBy(key)
        .agg(F.expr(best), F.expr("count(*) AS n_values"))
        .selectExpr(key, f"best.value AS {value}", "n_values")
    )


def modal_value_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """The modal value once per distinct value of its key, as a window would return it."""
    return repeat_rows(modal_value(df, key, value), "n_values")


def argmax_class(classes: Mapping[int, str], measures: list[str]) -> str:
    """SQL text: the first class whose value reaches the greatest measure, else the first class."""
    top = f"greatest({', '.join(measures)})"
    tests = " ".join(f"WHEN {value} >= {top} THEN {label}" for label, value in classes.items())
    return f"CASE {tests} ELSE {next(iter(classes))} END"


def with_fallback(
    df: DataFrame,
    other: DataFrame,
    key: str,
    column: str,
    fallback: str,
    result: str,
    salts: int = SALTS,
) -> DataFrame:
    """``column``, or where it is NULL the ``fallback`` that ``other`` holds for the key.

    ``other`` has at most one row per key.
    """
    side = other.selectExpr(f"{key} AS _key", f"{fallback} AS _fallback")
    return salted_left_join(df, side, key, "_key", df.columns, salts).selectExpr(
        *df.columns, f"coalesce({column}, _fallback) AS {result}"
    )


def dense_rank_by(df: DataFrame, score: str, result: str, salts: int = SALTS) -> DataFrame:
    """Dense rank of a whole number, the largest first, over the whole table.

    A window without partitions would move every row to one task. Here the distinct
    scores, less the smallest one, are ranked within buckets (bit length and up to ten leading
    bits), and only the per-bucket counts, at most 64 * 1024 rows, are summed in one place.
    Scores may be negative; a range beyond that of bigint fails the subtraction. ``df`` is read
    three times: pass a stored table. The rank joins back salted, as many rows may share a score.
    """
    whole = df.selectExpr(f"CAST({score} AS bigint) AS _score").filter("_score IS NOT NULL")
    least = whole.agg(F.min("_score")).scalar()
    leading = "shiftright(_above, greatest(length(bin(_above)) - 10, 0))"
    scores = (
        whole.distinct()
        .withColumn("_above", F.col("_score") - least)
        .selectExpr("_score", f"length(bin(_above)) * 1024 + {leading} AS _bucket")
    )
    above = "ORDER BY _bucket DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    offsets = (
        scores.groupBy("_bucket")
        .agg(F.expr("count(*) AS _size"))
        .selectExpr("_bucket", f"coalesce(sum(_size) OVER ({above}), 0) AS _offset")
    )
    within = "row_number() OVER (PARTITION BY _bucket ORDER BY _score DESC) AS _within"
    ranks = (
        scores.selectExpr("*", within)
        .join(offsets, "_bucket")
        .selectExpr("_score", f"_within + _offset AS {result}")
    )
    return salted_left_join(df, ranks, score, "_score", df.columns, salts).drop("_score")
