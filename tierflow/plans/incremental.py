"""The fact table kept up to date from what has changed in the silver tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame

from tierflow.operators.changes import row_changes
from tierflow.operators.join import SALTS
from tierflow.plans.star import build_fact
from tierflow.sources.paths import settled
from tierflow.specs import ROLLUPS, STAT_CATEGORIES

Repair = Callable[[DataFrame, DataFrame], DataFrame]


def fact_columns(category: str) -> list[str]:
    """The silver columns that the fact is computed from."""
    if category == "players":
        return ["player_id", "college", "current_team"]
    return list(dict.fromkeys(["player_id", "year", "team", *ROLLUPS[category].sums.values()]))


def _players_of(df: DataFrame) -> DataFrame:
    return df.selectExpr("CAST(player_id AS int) AS player_id").where("player_id IS NOT NULL")


def _with_value(
    silver: Mapping[str, DataFrame], changed: DataFrame, categories, column: str
) -> list[DataFrame]:
    """Players of the rows whose ``column`` is one of the ``changed`` values (``value``)."""
    return [
        _players_of(silver[c].join(changed, silver[c][column] == changed["value"], "left_semi"))
        for c in categories
    ]


def touched_players(
    old: Mapping[str, DataFrame],
    new: Mapping[str, DataFrame],
    dimensions: Mapping[str, tuple[DataFrame, DataFrame]] | None = None,
) -> DataFrame:
    """Distinct ``player_id`` of all players whose fact rows may differ.

    They are those of changed silver rows, also of rows that are gone, and those that name a
    college or team whose number of dimension rows has changed. ``dimensions`` has, under
    ``"college"`` and ``"team"``, the keys before and after as tables of one column.
    """
    categories = (*STAT_CATEGORIES, "players")
    found = [
        _players_of(row_changes(old[c].select(*fact_columns(c)), new[c].select(*fact_columns(c)), "_n"))
        for c in categories
    ]
    for kind, (before, after) in (dimensions or {}).items():
        changed = row_changes(before.toDF("value"), after.toDF("value"), "_n").select("value")
        if kind == "college":
            found += _with_value(new, changed, ["players"], "college")
        else:
            found += _with_value(new, changed, ["players"], "current_team")
            found += _with_value(new, changed, STAT_CATEGORIES, "team")
    return reduce(DataFrame.unionByName, found).distinct()


def update_fact(
    fact: DataFrame,
    old: Mapping[str, DataFrame],
    new: Mapping[str, DataFrame],
    colleges: DataFrame,
    teams: DataFrame,
    folder: str,
    rows: str = "counted",
    measure_type: str = "int",
    salts: int = SALTS,
    dimensions: Mapping[str, tuple[DataFrame, DataFrame]] | None = None,
    repair: Repair | None = None,
) -> DataFrame:
    """The fact that ``build_fact`` gives for ``new``, from the one that it gave for ``old``.

    Both versions of the columns that matter are compared once; careers, joins and lookups run for
    the touched players alone, and all other fact rows are taken over. A touched player who is gone
    loses its rows. ``repair`` is applied to the recomputed rows with the touched players' rows: it
    must work player by player, and have been applied to ``fact``. ``folder`` takes the list of
    touched players, as it is joined with every table; it must stay until the result is written.
    """
    touched = settled(touched_players(old, new, dimensions), f"{folder}/touched")
    ids = touched.withColumnRenamed("player_id", "_touched")
    part = {
        c: new[c].join(ids, new[c]["player_id"].cast("int") == ids["_touched"], "left_semi")
        for c in (*STAT_CATEGORIES, "players")
    }
    fresh = build_fact(part, colleges, teams, rows, measure_type, salts)
    if repair is not None:
        fresh = repair(fresh, part["players"])
    kept = fact.join(ids, fact["player_key"] == ids["_touched"], "left_anti")
    return kept.unionByName(fresh)
