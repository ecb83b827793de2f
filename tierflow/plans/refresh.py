"""Rebuild of a silver table when a newer snapshot of its raw table has more rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.changes import fingerprints
from tierflow.operators.refine import refine
from tierflow.sources.paths import exists, recover, replace_folder
from tierflow.sources.tables import RAW_OPTIONS, read_raw, write_silver
from tierflow.specs import clean_spec


def should_refresh(raw_rows: int, snapshot_rows: int) -> bool:
    """Only a snapshot with more rows counts as newer."""
    return snapshot_rows > raw_rows


def gate_report(pairs: Mapping[str, tuple[DataFrame, DataFrame | None]]) -> DataFrame:
    """Per name: row counts of raw table and snapshot, and whether to refresh.

    A missing snapshot (None) counts as 0 rows. All tables are counted in one job.
    """
    counts = [
        df.selectExpr(f"'{name}' AS name", f"'{side}' AS side", "count(*) AS n")
        for name, tables in pairs.items()
        for side, df in zip(("raw", "snapshot"), tables)
        if df is not None
    ]

    def rows(side: str):
        return F.expr(f"coalesce(sum(CASE WHEN side = '{side}' THEN n END), 0) AS {side}_rows")

    return (
        reduce(DataFrame.unionByName, counts)
        .groupBy("name")
        .agg(rows("raw"), rows("snapshot"))
        .selectExpr("*", "snapshot_rows > raw_rows AS refresh")
    )


def content_gate_report(pairs: Mapping[str, tuple[DataFrame, DataFrame | None]]) -> DataFrame:
    """As ``gate_report``, by content: ``by_content`` says that the snapshot's bag of rows is another.

    So a snapshot with as many rows, or fewer, is seen too; one that only has another order of rows or
    columns isn't new. Both tables of a pair have the same column names. Each is read once, and one
    row per table is shuffled. A missing snapshot is not new.
    """
    tables = {
        f"{side}:{name}": df
        for name, both in pairs.items()
        for side, df in zip(("raw", "snapshot"), both)
        if df is not None
    }
    marks = fingerprints(tables).selectExpr(
        "substring_index(name, ':', 1) AS side", "substring(name, instr(name, ':') + 1) AS name",
        "rows", "total", "mixed",
    )
    differ = " OR ".join(f"min({c}) <> max({c})" for c in ("rows", "total", "mixed"))

    def rows(side: str):
        return F.expr(f"coalesce(sum(CASE WHEN side = '{side}' THEN rows END), 0) AS {side}_rows")

    return (
        marks.groupBy("name")
        .agg(rows("raw"), rows("snapshot"), F.expr(f"count(*) = 2 AND ({differ}) AS by_content"))
        .selectExpr("name", "raw_rows", "snapshot_rows", "snapshot_rows > raw_rows AS by_rows", "by_content")
    )


def refresh_category(
    spark: SparkSession, category: str, raw_path: str, snapshot_path: str, silver_path: str
) -> bool:
    """Recompute silver from the snapshot alone and make the snapshot the raw table.

    A missing snapshot is no error, a missing raw table is. A snapshot without the
    ``_SUCCESS`` marker is still being written, or its import failed: it counts as missing. If
    the job stops between the two writes, the next run finds the gate still open and repeats
    both.
    """
    recover(spark, raw_path)
    raw_rows = read_raw(spark, category, raw_path).count()
    if not exists(spark, f"{snapshot_path.rstrip('/')}/_SUCCESS"):
        return False
    snapshot = read_raw(spark, category, snapshot_path)
    if not should_refresh(raw_rows, snapshot.count()):
        return False
    write_silver(refine(snapshot, clean_spec(category, "incremental")), silver_path)
    replace_folder(snapshot, raw_path, **RAW_OPTIONS)
    return True
