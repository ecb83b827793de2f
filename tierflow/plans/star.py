"""Dimensions, fact table, key backfill and ranking of the star schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.text import quoted
from tierflow.operators.derive import (
    argmax_class,
    count_copies,
    dense_rank_by,
    merge_copies,
    repeat_rows,
    with_fallback,
)
from tierflow.operators.fuse import careers_with_team
from tierflow.operators.join import SALTS, hot_left_join, salted_left_join
from tierflow.operators.refine import first_per_key
from tierflow.operators.rollup import max_per_key
from tierflow.schemas import (
    PLAYERS_DIM,
    POSITIONS,
    POSITIONS_DIM,
    TEAMS_DIM,
    fact_schema,
)
from tierflow.specs import STAT_CATEGORIES


def positions_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POSITIONS, POSITIONS_DIM)


def teams_dim(teams: DataFrame) -> DataFrame:
    return teams.select(*TEAMS_DIM.names)


def college_dim(
    colleges: DataFrame, key: str = "school", int_columns: Iterable[str] = ()
) -> DataFrame:
    """The colleges under their own column names, the key first; ``int_columns`` become integers."""
    numbers = set(int_columns)
    columns = [key, *[c for c in colleges.columns if c != key]]
    return colleges.selectExpr(
        *[f"try_cast({c} AS int) AS {c}" if c in numbers else quoted(c) for c in columns]
    )


def players_dim(players: DataFrame) -> DataFrame:
    """Players of the silver table under the dimension's column names."""
    source = {"player_key": "player_id", "city": "birth_city", "state": "birth_state"}
    return players.selectExpr(
        *[
            f"CAST({source.get(f.name, f.name)} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in PLAYERS_DIM
        ]
    )


def main_position() -> str:
    """SQL text: position key whose measure is the greatest; the earlier one wins a tie.

    Tackles are no candidate, so a player who only tackles gets position 1.
    """
    # Position key -> its measure.
    classes = {
        1: "passing_yards",
        2: "rushing_yards",
        3: "receiving_yards",
        4: "sacks",
        5: "ints",
        6: "fgs_made",
        7: "kick_return_tds + punt_return_tds",
    }
    measures = (
        "passing_yards rushing_yards receiving_yards sacks ints fgs_made kick_return_tds "
        "punt_return_tds"
    ).split()
    return argmax_class(classes, measures)


def years_played() -> str:
    """SQL text: first and last year."""
    return "concat(coalesce(y_min, ''), '-', coalesce(y_max, ''))"


def player_teams(players: DataFrame, usual_team: DataFrame) -> DataFrame:
    """Current team of each players row, else the usual one (NULL for players without rows).

    Equal rows are counted before the join and repeated after it.
    """
    rows = count_copies(players.selectExpr("CAST(player_id AS int) AS player_id", "current_team"))
    found = with_fallback(rows, usual_team, "player_id", "current_team", "team", "final_team")
    return repeat_rows(found.drop("current_team"), "copies")


def _lookup(
    df: DataFrame,
    dim: DataFrame,
    column: str,
    dim_key: str,
    result: str,
    salts: int,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left join to a dimension's key; ``copies`` grows where the key occurs several times.

    The dimension is reduced to its distinct keys. No broadcast is forced: Spark
    broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``; otherwise the salted join
    keeps a college or team that many players share, and missing ones, from one task. With ``hot``, a
    table that has the frequent keys, only these are salted.
    """
    keys = dim.groupBy(F.col(dim_key).alias(result)).agg(F.expr("count(*) AS _matches"))
    rest = [c for c in df.columns if c not in (column, "copies")]
    if hot is None:
        joined = salted_left_join(df, keys, column, result, ["player_id"], salts)
    else:
        joined = hot_left_join(df, keys, column, result, ["player_id"], salts, source=hot)
    return joined.selectExpr(*rest, result, "copies * coalesce(_matches, 1) AS copies")


def build_fact(
    silver: Mapping[str, DataFrame],
    colleges: DataFrame,
    teams: DataFrame,
    rows: str = "counted",
    measure_type: str = "int",
    salts: int = SALTS,
    lookups: str = "copies",
) -> DataFrame:
    """Fact table: one career per player with college, team and position keys.

    The plain join definition returns every player n * n * max(t, 1) times, for n players
    rows and t distinct teams. ``rows`` says how:

    - ``"counted"``: the distinct rows with their number in ``copies``;
    - ``"repeated"``: those rows, as the joins give them;
    - ``"single"``: one row per player, from its first players row, known values first.

    The joins run on counted rows in every form, never on the pairs. Sums that pass the
    int range fail the cast; give ``measure_type="bigint"`` for those.

    ``lookups`` says how hot colleges and teams are spread: ``"copies"`` repeats every dimension row
    for each salt, ``"hot"`` only those of keys that a sketch of the players finds frequent.
    """
    if lookups not in ("copies", "hot"):
        raise ValueError(f"lookups={lookups!r}")
    if rows not in ("repeated", "counted", "single"):
        raise ValueError(f"rows={rows!r}")
    stats = {name: silver[name] for name in STAT_CATEGORIES}
    people = silver["players"].filter("player_id IS NOT NULL")
    people = people.selectExpr("CAST(player_id AS int) AS player_id", "college", "current_team")
    return fact_from_careers(
        careers_with_team(stats), people, colleges, teams, rows, measure_type, salts, lookups
    )


def fact_from_careers(
    careers: DataFrame,
    people: DataFrame,
    colleges: DataFrame,
    teams: DataFrame,
    rows: str = "counted",
    measure_type: str = "int",
    salts: int = SALTS,
    lookups: str = "copies",
) -> DataFrame:
    """The fact from careers with their usual team, and the players' ``college`` and ``current_team``."""
    joined = careers
    if rows == "single":
        joined = joined.join(first_per_key(people, ["player_id"], nulls_last=True), "player_id")
        joined = joined.selectExpr("*", "1L AS copies")
        colleges, teams = colleges.select("school").distinct(), teams.select("team_name").distinct()
    else:
        # one shuffle of the players for both counts
        alike = people.groupBy("player_id", "college", "current_team").agg(F.expr("count(*) AS _n"))
        by_college = alike.groupBy("player_id", "college").agg(F.expr("sum(_n) AS _n_college"))
        by_team = alike.groupBy("player_id", "current_team").agg(F.expr("sum(_n) AS _n_team"))
        joined = (
            joined.join(by_college, "player_id")
            .join(by_team, "player_id")
            .selectExpr("*", "_n_college * _n_team * n_values AS copies")
        )
    joined = joined.selectExpr("*", "coalesce(current_team, team) AS final_team")
    hot = {"college": people, "final_team": people.selectExpr("current_team AS final_team")}
    hot = hot if lookups == "hot" else dict.fromkeys(hot)
    joined = _lookup(joined, colleges, "college", "school", "college_key", salts, hot["college"])
    joined = _lookup(joined, teams, "final_team", "team_name", "team_key", salts, hot["final_team"])

    computed = {
        "player_key": "player_id",
        "position_key": main_position(),
        "years_played": years_played(),
    }
    fact = joined.selectExpr(
        *[
            f"CAST({computed.get(f.name, f.name)} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in fact_schema(measure_type)
        ],
        "copies",
    )
    if rows == "single":
        return fact.drop("copies")
    if rows == "counted":
        return merge_copies(fact)
    return repeat_rows(fact, "copies")


def _with_college(fact: DataFrame, fix: DataFrame) -> DataFrame:
    """COALESCE(fix, fact) on the college key; ``fix`` has columns _key and _college."""
    others = [c for c in fact.columns if c not in ("player_key", "college_key")]
    extra = [c for c in fix.columns if c not in ("_key", "_college")]
    return fact.join(fix, F.expr("player_key = _key"), "left").selectExpr(
        "player_key", "coalesce(_college, college_key) AS college_key", *others, *extra
    )


def backfill_null_only(
    fact: DataFrame, players: DataFrame, unique: bool = False
) -> DataFrame:
    """First-load repair: players with a NULL college key take their college text.

    A player's fact rows are repeated once per pair of its NULL-key rows and players
    rows, as the plain joins do; the pairs are counted per college, not joined. A fact of
    counted rows stays counted. The fact is read twice: pass a stored one.

    ``unique`` says that the fact has one row per player: that stays one row, and a NULL key
    becomes the player's greatest college text.
    """
    if unique:
        fix = _greatest_college(players)
        others = [c for c in fact.columns if c not in ("player_key", "college_key")]
        return fact.join(fix, F.expr("player_key = _key"), "left").selectExpr(
            "player_key", "coalesce(college_key, _college) AS college_key", *others
        )
    counted = "copies" in fact.columns
    rows = fact if counted else count_copies(fact)
    gaps = (
        rows.filter("college_key IS NULL")
        .groupBy(F.col("player_key").alias("_id"))
        .agg(F.expr("sum(copies) AS _gaps"))
    )
    colleges = (
        players.filter("player_id IS NOT NULL")
        .groupBy(F.expr("CAST(player_id AS int) AS _key"), F.col("college").alias("_college"))
        .agg(F.expr("count(*) AS _rows"))
    )
    fix = colleges.join(gaps, F.expr("_key = _id")).selectExpr(
        "_key", "_college", "_rows * _gaps AS _times"
    )
    kept = [c for c in fact.columns if c != "copies"]
    filled = _with_college(rows, fix).selectExpr(
        *kept, "copies * coalesce(_times, 1) AS copies"
    )
    return merge_copies(filled) if counted else repeat_rows(filled, "copies")


def _greatest_college(players: DataFrame) -> DataFrame:
    """``_key`` and ``_college``: each player's greatest college text."""
    named = players.selectExpr("CAST(player_id AS int) AS _key", "college AS _college").filter(
        "_key IS NOT NULL AND _college IS NOT NULL"
    )
    return max_per_key(named, "_key", "_college")


def backfill_max(fact: DataFrame, players: DataFrame, unique: bool = False) -> DataFrame:
    """Recurring repair: each player's greatest college text, also over a key already set.

    Equal fact rows are counted before the join and repeated after it, unless ``unique``
    says that the fact has one row per player. A fact of counted rows stays counted.
    """
    fix = _greatest_college(players)
    if unique:
        return _with_college(fact, fix)
    if "copies" in fact.columns:
        return merge_copies(_with_college(fact, fix))
    return repeat_rows(_with_college(count_copies(fact), fix), "copies")


def college_scores(fact: DataFrame, positions: DataFrame) -> DataFrame:
    """Colleges with the good years of their players, weighted by position difficulty.

    Each player counts once per college, whatever the number of its fact rows. The
    positions table is the seven-row constant, so it is broadcast.
    """
    players = (
        fact.filter("college_key IS NOT NULL")
        .select("college_key", "player_key", "position_key", "good_years")
        .dropDuplicates(["college_key", "player_key"])
    )
    weighted = players.join(
        F.broadcast(positions.select("position_key", "difficulty")), "position_key", "left"
    )
    totals = [
        "count(*) AS players",
        "sum(good_years) AS good_years",
        "sum(good_years * coalesce(difficulty, 0)) AS weighted_years",
    ]
    return weighted.groupBy("college_key").agg(*map(F.expr, totals))


def college_ranking(scores: DataFrame, salts: int = SALTS) -> DataFrame:
    """``college_scores`` with their dense rank. The scores are read several times: store them."""
    return dense_rank_by(scores, "weighted_years", "college_rank", salts)
