"""Checks a user looks at; never part of a transform."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.refine import refine_observed
from tierflow.operators.rollup import row_counts
from tierflow.sources.tables import write_silver
from tierflow.specs import CleanSpec

view_counts = row_counts


def match_audit(players: DataFrame, colleges: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` players with their college text and the matching school, if any.

    Every player gives at least one row, so the first ``n`` of them are enough to join.
    """
    first = players.select("player_id", "college").orderBy("player_id", "college").limit(n)
    pairs = first.join(colleges.select("school"), F.expr("college = school"), "left")
    return pairs.orderBy("player_id", "college", "school").limit(n)


def match_summary(players: DataFrame, colleges: DataFrame) -> DataFrame:
    """Players rows per (matched or not), over the whole table; counted before the join."""
    counts = players.groupBy("college").agg(F.expr("count(*) AS _rows"))
    keys = colleges.select("school").distinct()
    pairs = counts.join(keys, F.expr("college = school"), "left")
    return pairs.groupBy(F.expr("school IS NOT NULL AS matched")).agg(F.expr("sum(_rows) AS c"))


def preview(tables: Mapping[str, DataFrame], n: int = 20) -> None:
    """Print schema and first rows of each table; runs each plan."""
    for name, df in tables.items():
        print(name)
        df.printSchema()
        df.show(n, truncate=False)


def describe(spark: SparkSession, table: str) -> DataFrame:
    """Columns, format, location and properties of a catalog table."""
    return spark.sql(f"DESCRIBE FORMATTED {table}")


def write_refined(df: DataFrame, spec: CleanSpec, path: str) -> dict[str, int]:
    """Clean a raw table into ``path``; what was read, dropped by each test, not parsed, and kept.

    The counts come from the job that writes, which reads the table once.
    """
    seen, parsed = Observation(), Observation()
    write_silver(refine_observed(df, spec, seen, parsed), path)
    return {**seen.get, **parsed.get}
