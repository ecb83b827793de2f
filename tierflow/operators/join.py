"""Joins that hold when one key has a large part of all rows."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.text import quoted

SALTS = 8
#: Share of the rows from which a key counts as hot.
HOT_SHARE = 1 / 64


def salted_left_join(
    df: DataFrame,
    side: DataFrame,
    key: str,
    side_key: str,
    spread: Iterable[str],
    salts: int = SALTS,
) -> DataFrame:
    """Left join in which the rows of one key, also of a NULL key, go to ``salts`` tasks.

    A row's salt is a hash of its ``spread`` columns, so a rerun task gives it the same
    one; ``side`` is repeated for every salt. The repeat also puts a shuffle of its own
    below the join, which lets adaptive execution split what is still too large, and a
    small ``side`` is broadcast as in a plain join. ``salts=1`` is the plain join: for a side
    that is broadcast anyway, the copies would serve nothing.
    """
    if salts == 1:
        return df.join(side, F.expr(f"{key} = {side_key}"), "left")
    columns = ", ".join(map(quoted, spread))
    left = df.selectExpr("*", f"pmod(hash({columns}), {salts}) AS _salt")
    right = side.selectExpr("*", f"explode(sequence(0, {salts - 1})) AS _copy")
    matches = F.expr(f"{key} = {side_key} AND _salt = _copy")
    return left.join(right, matches, "left").drop("_salt", "_copy")


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> Column:
    """The values of ``key`` that at least ``share`` of the rows have, as an array.

    One pass with a mergeable sketch of the most frequent values, whose size and error depend on
    ``share`` alone: every such value is found, and at most ``2 / share`` values are returned. It is a
    subquery, which Spark runs once, when the plan that uses it runs.
    """
    tracked = 1 << math.ceil(math.log2(16 / share))
    found = f"approx_top_k({quoted(key)}, {math.ceil(2 / share)}, {tracked})"
    enough = f"x -> x.item IS NOT NULL AND x.count >= {share:.12f} * count(*)"
    return df.selectExpr(f"transform(filter({found}, {enough}), x -> x.item)").scalar()


def copies_of_hot(side: DataFrame, hot: Column, side_key: str, salts: int = SALTS) -> DataFrame:
    """``side`` with a row for each ``_copy`` from 0: ``salts`` of hot keys' rows, one of all others."""
    copied = F.coalesce(F.array_contains(hot, F.col(side_key)), F.lit(False))
    numbers = F.when(copied, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return side.withColumn("_copy", F.explode(numbers))


def hot_left_join(
    df: DataFrame,
    side: DataFrame,
    key: str,
    side_key: str,
    spread: Iterable[str],
    salts: int = SALTS,
    share: float = HOT_SHARE,
    source: DataFrame | None = None,
) -> DataFrame:
    """``salted_left_join`` that salts only where needed: hot keys, and NULL keys, which match nothing.

    The rows of ``side`` are repeated for hot keys alone, so at most ``2 * salts / share`` distinct
    keys get copies, however large ``side`` is. ``source`` is a table that has the same hot keys and is
    cheaper to read than ``df`` (by default ``df``, which is then computed twice).
    """
    hot = hot_keys(df if source is None else source, key, share)
    columns = ", ".join(map(quoted, spread))
    is_hot = F.coalesce(F.array_contains(hot, F.col(key)), F.lit(False))
    left = df.withColumn(
        "_salt",
        F.when(F.col(key).isNull() | is_hot, F.expr(f"pmod(hash({columns}), {salts})")).otherwise(0),
    )
    right = copies_of_hot(side, hot, side_key, salts)
    matches = F.expr(f"{key} = {side_key} AND _salt = _copy")
    return left.join(right, matches, "left").drop("_salt", "_copy")
