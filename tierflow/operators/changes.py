"""What differs between two versions of a table: order-free fingerprints and signed row counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.text import quoted

#: Two hashes of a row with different beginnings, so that one unlucky pair of values isn't enough.
_SEEDS = (17, 90001)


@dataclass(frozen=True)
class Fingerprint:
    """Rows of a table, and sums and exclusive ors of their hashes: equal for equal bags of rows."""

    rows: int = 0
    total: str = "0"
    mixed: str = "0"

    def to_dict(self) -> dict[str, int | str]:
        return asdict(self)


def row_hash(columns: Iterable[str], seed: int) -> str:
    """SQL text: 64-bit hash of a row by column name. NULL is a value of its own."""
    parts = [f"{quoted(c)}, {quoted(c)} IS NULL" for c in sorted(columns)]
    return f"xxhash64({', '.join([str(seed), *parts])})"


def fingerprint_aggregates(columns: Iterable[str]) -> list[str]:
    """SQL texts of the aggregates ``rows``, ``total`` and ``mixed`` over a table's rows.

    They add up: tasks combine before the one-row shuffle, and neither the order of rows nor that of
    columns matters. The sum is a decimal, as hashes of some rows pass the range of bigint.
    """
    columns = list(columns)
    first, second = (row_hash(columns, seed) for seed in _SEEDS)
    return [
        "count(*) AS rows",
        f"CAST(coalesce(sum(CAST({first} AS DECIMAL(20, 0))), 0) AS STRING) AS total",
        f"CAST(coalesce(bit_xor({second}), 0) AS STRING) AS mixed",
    ]


def fingerprints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table, ``name``, ``rows``, ``total`` and ``mixed``; each table is read once."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(*map(F.expr, fingerprint_aggregates(df.columns))).selectExpr(f"'{name}' AS name", "*")
            for name, df in tables.items()
        ],
    )


def fingerprint(df: DataFrame) -> Fingerprint:
    """Reads the table once."""
    row = df.agg(*map(F.expr, fingerprint_aggregates(df.columns))).first()
    return Fingerprint(row.rows, row.total, row.mixed)


def fingerprints_by(df: DataFrame, key: str) -> DataFrame:
    """``key`` and the fingerprint of its rows, for comparison of tables part by part."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(*map(F.expr, fingerprint_aggregates(others)))


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` whose rows differ, as ``key`` with ``in_old`` and ``in_new``; NULL is a value."""
    marks = ["rows", "total", "mixed"]
    sides = fingerprints_by(old, key).selectExpr("*", "true AS _old").unionByName(
        fingerprints_by(new, key).selectExpr("*", "false AS _old")
    )
    # a key has at most two rows here
    same = " AND ".join(f"min({c}) = max({c})" for c in marks)
    return (
        sides.groupBy(key)
        .agg(
            F.expr("bool_or(_old) AS in_old"),
            F.expr("bool_or(NOT _old) AS in_new"),
            F.expr(f"count(*) = 2 AND {same} AS _same"),
        )
        .where("NOT _same")
        .drop("_same")
    )


def row_changes(old: DataFrame, new: DataFrame, count: str = "n") -> DataFrame:
    """Multiset difference: each distinct row with how many more ``new`` has, negative where fewer.

    Rows are counted with sign on the map side and shuffled once; equal rows cancel out. One that a
    third of the table repeats is one row for each task.
    """
    columns = new.columns
    signed = old.selectExpr(*map(quoted, columns), f"-1L AS {quoted(count)}").unionByName(
        new.selectExpr("*", f"1L AS {quoted(count)}")
    )
    return (
        signed.groupBy(*map(quoted, columns))
        .agg(F.expr(f"sum({quoted(count)}) AS {quoted(count)}"))
        .where(f"{quoted(count)} <> 0")
    )


def apply_changes(old: DataFrame, changes: DataFrame, count: str = "n") -> DataFrame:
    """Distinct rows of the version after the changes, with their number in ``count``."""
    columns = old.columns
    return (
        old.selectExpr("*", f"1L AS {quoted(count)}")
        .unionByName(changes.select(*columns, count))
        .groupBy(*map(quoted, columns))
        .agg(F.expr(f"sum({quoted(count)}) AS {quoted(count)}"))
        .where(f"{quoted(count)} > 0")
    )
