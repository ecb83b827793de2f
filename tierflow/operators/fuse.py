"""One row per key from the roll-ups of several categories."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.specs import ROLLUPS, RollupSpec

_FRACTIONAL = {"float", "double"}


def fuse_outer(
    rollups: Mapping[str, DataFrame],
    key: str = "player_id",
    specs: Mapping[str, RollupSpec] = ROLLUPS,
) -> DataFrame:
    """Chain of full outer joins over the roll-ups, absent measures as 0.

    Kept as the plain definition; ``fuse_union`` gives the same rows for non-NULL keys
    without a shuffle per category.
    """
    fused = None
    measures: list[str] = []
    for name, rolled in rollups.items():
        own = list(specs[name].sums)
        side = rolled.selectExpr(f"{key} AS _other", *own)
        if fused is None:
            fused = side.withColumnRenamed("_other", key)
        else:
            fused = fused.join(side, F.expr(f"{key} = _other"), "full").selectExpr(
                f"coalesce({key}, _other) AS {key}", *measures, *own
            )
        measures += own
    return fused.selectExpr(key, *[f"coalesce({m}, 0) AS {m}" for m in measures])


def _slots(silver: Mapping[str, DataFrame], specs: Mapping[str, RollupSpec]):
    """Give each measure a slot of its type, so that categories share columns in the union."""
    layout: dict[str, dict[str, str]] = {}
    for name, spec in specs.items():
        types = dict(silver[name].dtypes)
        used = {"n": 0, "x": 0}
        layout[name] = {}
        for out, source in spec.sums.items():
            letter = "x" if types[source] in _FRACTIONAL else "n"
            layout[name][out] = f"{letter}{used[letter]}"
            used[letter] += 1
    return layout


def _season_rows(
    df: DataFrame, tag: int, spec: RollupSpec, layout, slots, key: str, others: list[str]
) -> DataFrame:
    filled = {slot: f"coalesce({spec.sums[out]}, 0)" for out, slot in layout.items()}
    kinds = {"n": "bigint", "x": "double"}
    return df.selectExpr(
        f"CAST({key} AS int) AS {key}",
        f"CAST({tag} AS tinyint) AS category",
        *others,
        *[f"CAST({filled.get(s, 'NULL')} AS {kinds[s[0]]}) AS {s}" for s in slots],
    )


def _tagged(silver, key: str, others: list[str], specs, drop_null_key: bool):
    """Union of all categories' rows with a tag, and where each measure is in it."""
    layout = _slots(silver, specs)
    slots = sorted({slot for columns in layout.values() for slot in columns.values()})
    rows = reduce(
        DataFrame.unionByName,
        [
            _season_rows(silver[n], i, spec, layout[n], slots, key, others)
            for i, (n, spec) in enumerate(specs.items())
        ],
    )
    return (rows.filter(f"{key} IS NOT NULL") if drop_null_key else rows), layout, slots


def _career_measures(layout, specs, year: str, grain: str = "TRUE") -> list[str]:
    """Aggregates of season rows, those for which ``grain`` holds, to careers."""
    tags = {name: i for i, name in enumerate(specs)}
    totals = [
        f"coalesce(sum(CASE WHEN {grain} AND category = {tags[name]} THEN {slot} END), 0) AS {out}"
        for name, columns in layout.items()
        for out, slot in columns.items()
    ]
    years = ", ".join(
        f"count(CASE WHEN {grain} AND category = {tag} THEN {year} END)" for tag in tags.values()
    )
    ends = [
        f"min(CASE WHEN {grain} THEN {year} END) AS y_min",
        f"max(CASE WHEN {grain} THEN {year} END) AS y_max",
    ]
    return [*totals, f"greatest({years}) AS good_years", *ends]


def career_totals(
    silver: Mapping[str, DataFrame],
    key: str = "player_id",
    year: str = "year",
    specs: Mapping[str, RollupSpec] = ROLLUPS,
    drop_null_key: bool = True,
) -> DataFrame:
    """Per key: every measure summed, ``good_years``, and first and last year.

    ``good_years`` is the largest number of distinct years in one category. Each table is
    read once; rows are first summed per (key, category, year), so that what reaches the
    final aggregation of one key is bounded by its distinct years, not by its rows.
    """
    rows, layout, slots = _tagged(silver, key, [year], specs, drop_null_key)
    seasons = rows.groupBy(key, "category", year).agg(
        *[F.expr(f"sum({s}) AS {s}") for s in slots]
    )
    return seasons.groupBy(key).agg(*map(F.expr, _career_measures(layout, specs, year)))


def careers_with_team(
    silver: Mapping[str, DataFrame],
    key: str = "player_id",
    year: str = "year",
    team: str = "team",
    specs: Mapping[str, RollupSpec] = ROLLUPS,
) -> DataFrame:
    """``career_totals`` with the usual team and ``n_values``, the number of different teams.

    The same reading and the same two shuffles give both: the first aggregation has the grains
    (key, category, year) and (key, team), of which the second takes sums and the most
    frequent team. Ties go to the smaller team, NULL first. A key's rows in the second
    shuffle are bounded by its seasons and teams. Keys that are NULL are left out.
    """
    rows, layout, slots = _tagged(silver, key, [year, team], specs, True)
    grains = rows.groupingSets(
        [[key, "category", year], [key, team]], key, "category", year, team
    ).agg(
        *[F.expr(f"sum({s}) AS {s}") for s in slots],
        F.expr("count(*) AS _rows"),
        F.expr("grouping_id() AS _grain"),
    )
    # bits of the grain: what is summed over of key, category, year, team
    season, by_team = "_grain = 1", "_grain = 6"
    best = f"min(CASE WHEN {by_team} THEN named_struct('rank', -_rows, 'value', {team}) END) AS _best"
    careers = grains.groupBy(key).agg(
        *map(F.expr, _career_measures(layout, specs, year, season)),
        F.expr(best),
        F.expr(f"count(CASE WHEN {by_team} THEN 1 END) AS n_values"),
    )
    return careers.withColumn(team, F.col("_best.value")).drop("_best")


def fuse_union(
    silver: Mapping[str, DataFrame],
    key: str = "player_id",
    specs: Mapping[str, RollupSpec] = ROLLUPS,
    drop_null_key: bool = True,
) -> DataFrame:
    """The measures of ``fuse_outer`` from the silver tables, in one aggregation.

    Without years there is no need to group by season: the union of all tables is summed
    on the map side and shuffled once by key.
    """
    kinds = {}
    for name, spec in specs.items():
        types = dict(silver[name].dtypes)
        for out, source in spec.sums.items():
            kinds[out] = "double" if types[source] in _FRACTIONAL else "bigint"

    def part(name: str) -> DataFrame:
        own = specs[name].sums
        values = [f"CAST({own.get(out, 'NULL')} AS {kind}) AS {out}" for out, kind in kinds.items()]
        return silver[name].selectExpr(f"CAST({key} AS int) AS {key}", *values)

    rows = reduce(DataFrame.unionByName, map(part, specs))
    if drop_null_key:
        rows = rows.filter(f"{key} IS NOT NULL")
    return rows.groupBy(key).agg(*[F.expr(f"coalesce(sum({m}), 0) AS {m}") for m in kinds])
