"""The whole run: raw or snapshot tables to silver, then fact and gold."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tierflow.operators.derive import repeat_rows
from tierflow.operators.refine import refine
from tierflow.plans.refresh import refresh_category
from tierflow.plans.star import (
    backfill_max,
    backfill_null_only,
    build_fact,
    college_dim,
    players_dim,
    positions_dim,
    teams_dim,
)
from tierflow.settings import tune
from tierflow.sources.paths import scratch, settled
from tierflow.sources.tables import publish, read_raw, read_silver, write_silver
from tierflow.specs import clean_spec

# The order in which categories are refreshed.
RUN_ORDER = ("players", "defensive", "kicking", "rushing", "receiving", "returns", "passing")


@dataclass(frozen=True)
class BatchConfig:
    """Folders of the run; each category has a subfolder of its name."""

    raw: str
    snapshot: str
    silver: str
    gold: str
    fact_rows: str = "counted"
    measure_type: str = "int"
    college_ints: tuple[str, ...] = ()

    def of(self, layer: str, name: str) -> str:
        return f"{getattr(self, layer).rstrip('/')}/{name}"


def first_load(spark: SparkSession, config: BatchConfig) -> None:
    """Clean every raw table into silver."""
    for category in RUN_ORDER:
        raw = read_raw(spark, category, config.of("raw", category))
        write_silver(refine(raw, clean_spec(category)), config.of("silver", category))


def refresh_all(spark: SparkSession, config: BatchConfig) -> dict[str, bool]:
    """Refresh each category whose snapshot has more rows; tells which were."""
    return {
        category: refresh_category(
            spark, category, *[config.of(layer, category) for layer in ("raw", "snapshot", "silver")]
        )
        for category in RUN_ORDER
    }


def gold_tables(
    spark: SparkSession,
    config: BatchConfig,
    colleges: DataFrame,
    teams: DataFrame,
    folder: str,
    first: bool = False,
) -> Mapping[str, DataFrame]:
    """Dimensions and repaired fact, from the silver folders.

    The first load repairs only missing college keys, later runs all of them. The repair
    works on counted rows; they are repeated only when they are written. ``folder`` takes the
    fact before its repair; it must stay until the tables are written.
    """
    silver = {
        c: read_silver(spark, clean_spec(c), config.of("silver", c)) for c in RUN_ORDER
    }
    single = config.fact_rows == "single"
    rows = "single" if single else "counted"
    fact = build_fact(silver, colleges, teams, rows, config.measure_type)
    if single:
        repair = backfill_null_only if first else backfill_max
        fact = repair(fact, silver["players"], unique=True)
    elif first:
        fact = backfill_null_only(settled(fact, f"{folder}/fact"), silver["players"])
    else:
        fact = backfill_max(fact, silver["players"])
    if config.fact_rows == "repeated":
        fact = repeat_rows(fact, "copies")
    return {
        "positions_dim": positions_dim(spark),
        "college_dim": college_dim(colleges, int_columns=config.college_ints),
        "teams_dim": teams_dim(teams),
        "players_dim": players_dim(silver["players"]),
        "fact_player_stats": fact,
    }


def run_batch(
    spark: SparkSession,
    config: BatchConfig,
    colleges: DataFrame,
    teams: DataFrame,
    first: bool = False,
) -> dict[str, bool]:
    """First load or refresh of all categories, then publish of the five gold tables.

    The first load appends to gold, later runs replace it. The fact is computed with its
    repair before its only write, so no table is overwritten while it is read.
    """
    tune(spark)
    if first:
        first_load(spark, config)
        changed = dict.fromkeys(RUN_ORDER, True)
    else:
        changed = refresh_all(spark, config)
    with scratch(spark) as folder:
        tables = gold_tables(spark, config, colleges, teams, folder, first)
        publish(tables, config.gold, "append" if first else "overwrite")
    return changed
