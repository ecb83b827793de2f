"""Messy all-text tables derived from the given parquet tables.

Each table is a list of expressions that Spark SQL and DuckDB both understand, so the
query and its check read the same text. Every row of the source table gives one row
(``players`` one or two); remainders only choose how a value is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.schemas import RAW_COLUMNS


def text(value: str) -> str:
    return f"CAST({value} AS STRING)"


def whole(value: str) -> str:
    return f"CAST(floor({value}) AS BIGINT)"


def number(value: str, salt: str) -> str:
    """A whole number as people type it: dashes, blanks, fractions, commas, padding."""
    thousands = whole(f"({value}) / 1000")
    return (
        f"CASE WHEN ({salt}) % 29 = 0 THEN '--' WHEN ({salt}) % 31 = 0 THEN '  ' "
        f"WHEN ({salt}) % 37 = 0 THEN {text(value)} || '.7' "
        f"WHEN ({salt}) % 41 = 0 THEN 'n/a' "
        f"WHEN ({salt}) % 43 = 0 THEN {text(value)} || 'e1' "
        f"WHEN ({value}) >= 1000 THEN {text(thousands)} || ',' || "
        f"lpad({text(f'({value}) % 1000')}, 3, '0') "
        f"ELSE ' ' || {text(value)} || ' ' END"
    )


def fraction(value: str, salt: str) -> str:
    """A number with a half, or text that is none."""
    return (
        f"CASE WHEN ({salt}) % 23 = 0 THEN '--' WHEN ({salt}) % 29 = 0 THEN '' "
        f"WHEN ({salt}) % 31 = 0 THEN '1,' || {text(value)} || '.5' "
        f"WHEN ({salt}) % 2 = 0 THEN {text(value)} || '.5' ELSE {text(value)} END"
    )


def key(value: str, salt: str) -> str:
    return (
        f"CASE WHEN ({salt}) % 53 = 0 THEN 'no/key' WHEN ({salt}) % 3 = 0 THEN 'p/' || {text(value)} "
        f"WHEN ({salt}) % 3 = 1 THEN 'a/b c/' || {text(value)} ELSE ' ' || {text(value)} END"
    )


def name(value: str, salt: str) -> str:
    return (
        f"CASE WHEN ({salt}) % 47 = 0 THEN 'Solo' WHEN ({salt}) % 37 = 0 THEN 'Last,First' "
        f"WHEN ({salt}) % 31 = 0 THEN 'Last' || {text(value)} || ', First, Jr' "
        f"ELSE '  Last' || {text(value)} || ', First' || {text(f'({value}) % 7')} || ' ' END"
    )


def year(date: str, salt: str) -> str:
    return (
        f"CASE WHEN ({salt}) % 17 = 0 THEN '1969' WHEN ({salt}) % 59 = 0 THEN '--' "
        f"WHEN ({salt}) % 61 = 0 THEN '' ELSE {text(f'year({date})')} END"
    )


def team(value: str, salt: str) -> str:
    group = whole(f"({value}) / 20")
    return (
        f"CASE WHEN ({salt}) % 67 = 0 THEN '' WHEN ({salt}) % 71 = 0 THEN '--' "
        f"ELSE 'TEAM_' || {text(f'{group} + ({salt}) % 2')} END"
    )


def _who(player: str, key_salt: str, salt: str) -> dict[str, str]:
    return {
        "player_id": key(player, key_salt),
        "name": name(player, salt),
        "team": team(player, salt),
    }


_LINE = "l_orderkey + l_linenumber"
_QUANTITY = "CAST(l_quantity AS BIGINT)"
_COMMON = {
    "lineitem": {
        **_who("l_partkey", _LINE, "l_orderkey"),
        "position": "l_returnflag",
        "postion": "l_returnflag",
        "year": year("l_shipdate", _LINE),
        "games_played": text("l_linenumber"),
    },
    "orders": {
        **_who("o_custkey", "o_orderkey", "o_orderkey"),
        "position": "o_orderstatus",
        "postion": "o_orderstatus",
        "year": year("o_orderdate", "o_orderkey"),
        "games_played": "o_orderpriority",
    },
    "events": {
        "position": "event_type",
        "year": year("ts", "user_id"),
        "games_played": text("user_id % 16"),
    },
}

_SOURCES: dict[str, tuple[str, dict[str, str]]] = {
    "passing": (
        "lineitem",
        {
            **_who("l_suppkey", _LINE, "l_orderkey"),
            "passes_attempted": number(f"{_QUANTITY} * 13", "l_orderkey"),
            "passes_completed": number(f"{_QUANTITY} * 9", "l_partkey"),
            "completion_percentage": fraction(_QUANTITY, _LINE),
            "passing_yards": number(whole("l_extendedprice / 20"), _LINE),
            "passing_yards_per_attempt": fraction("l_linenumber", "l_orderkey"),
            "td_passes": number("l_linenumber * 3", "l_suppkey"),
            "ints": number("l_suppkey % 20", _LINE),
            "sacks": fraction("l_linenumber", "l_partkey"),
            "passer_rating": fraction(_QUANTITY, "l_suppkey"),
        },
    ),
    "rushing": (
        "orders",
        {
            "rushing_attempts": number("o_custkey % 400", "o_orderkey"),
            "rushing_yards": number(whole("o_totalprice / 200"), "o_orderkey"),
            "yards_per_carry": fraction("o_custkey % 9", "o_orderkey"),
            "rushing_tds": number("o_orderkey % 21", "o_custkey"),
            "longest_rushing_run": f"{text('o_orderkey % 99')} || "
            "CASE WHEN o_custkey % 2 = 0 THEN 'T' ELSE '' END",
            "rushing_first_downs": number("o_orderkey % 120", "o_custkey"),
            "percentage_of_rushing_first": fraction("o_custkey % 60", "o_custkey"),
            "fumbles": number("o_orderkey % 5", "o_orderkey"),
        },
    ),
    "receiving": (
        "orders",
        {
            "receptions": number("o_custkey % 150", "o_orderkey"),
            "receiving_yards": number(whole("o_totalprice / 150"), "o_orderkey + o_custkey"),
            "yards_per_reception": fraction("o_custkey % 20", "o_orderkey"),
            "longest_reception": f"'T' || {text('o_custkey % 99')}",
            "receiving_tds": number("o_orderkey % 18", "o_custkey"),
            "first_down_receptions": number("o_orderkey % 70", "o_custkey"),
            "fumbles": number("o_custkey % 5", "o_orderkey"),
        },
    ),
    "defensive": (
        "lineitem",
        {
            "total_tackles": fraction(f"{_QUANTITY} * 3", "l_suppkey"),
            "solo_tackles": number(f"{_QUANTITY} * 2", _LINE),
            "assisted_tackles": number(_QUANTITY, "l_orderkey"),
            "sacks": fraction("l_linenumber * 2", _LINE),
            "safties": number("l_linenumber % 3", "l_partkey"),
            "passes_defended": number("l_suppkey % 30", _LINE),
            "ints": number("l_suppkey % 8", "l_orderkey"),
            "ints_for_tds": number("l_suppkey % 3", "l_partkey"),
            "int_yards": number(whole("l_extendedprice / 90"), "l_partkey"),
        },
    ),
    "kicking": (
        "lineitem",
        {
            **_who("l_partkey * 2", _LINE, "l_orderkey"),
            "kicks_blocked": number("l_linenumber", "l_partkey"),
            "longest_fg_made": f"{text('20 + l_suppkey % 44')} || '*'",
            "fgs_made": number(_QUANTITY, _LINE),
            "fgs_attempted": number(f"{_QUANTITY} + l_linenumber", "l_orderkey"),
            "fg_percentage": fraction(_QUANTITY, "l_partkey"),
            **{
                f"fgs_{what}_{r}_yards": number(f"l_suppkey % {n}", "l_partkey")
                for n, r in enumerate(("2029", "3039", "4049", "50"), 5)
                for what in ("made", "attempted")
            },
            **{
                f"fgs_percentage_{r}_yards": fraction(f"l_suppkey % {n}", _LINE)
                for n, r in enumerate(("2029", "3039", "4049", "50"), 50)
            },
            "extra_points_attempted": number(whole("l_extendedprice / 60"), "l_orderkey"),
            "extra_points_made": number(whole("l_extendedprice / 70"), "l_suppkey"),
            "percentage_of_extra_points": fraction(_QUANTITY, "l_orderkey"),
            "extra_points_blocked": "'0'",
        },
    ),
    "returns": (
        "events",
        {
            **_who("user_id * 17", "user_id", "event_id % 3"),
            "kick_returns": number("user_id % 40", "event_id % 50"),
            "yards_kick_returned": number("user_id * 10", "event_id % 50"),
            "kick_returns_for_tds": number("event_id % 4", "user_id"),
            "punt_returns": number("user_id % 30", "event_id % 50"),
            "yards_punt_returned": number("user_id * 11", "user_id"),
            "punt_returns_for_tds": number("event_id % 3", "event_id % 50"),
        },
    ),
}

_BIRTHDAY = (
    "CASE WHEN c_custkey % 19 = 0 THEN 'unknown' WHEN c_custkey % 23 = 0 THEN '4/5/82' "
    "WHEN c_custkey % 29 = 0 THEN '13/45/1990' WHEN c_custkey % 31 = 0 THEN '2/30/1985' "
    f"WHEN c_custkey % 2 = 0 THEN lpad({text('1 + c_custkey % 12')}, 2, '0') || '/' || "
    f"lpad({text('1 + c_custkey % 28')}, 2, '0') || '/' || {text('1950 + c_custkey % 50')} "
    f"ELSE ' ' || {text('1 + c_custkey % 12')} || '/' || {text('1 + c_custkey % 28')} || '/' || "
    f"{text('1950 + c_custkey % 50')} END"
)


def _players(copy: int) -> dict[str, str]:
    """Second rows repeat the first one's key; for a quarter of the players with other years."""
    years = "1" if copy == 1 else "CASE WHEN c_custkey % 4 = 1 THEN 2 ELSE 1 END"
    return {
        "age": text("20 + c_custkey % 20"),
        "birth_place": "CASE WHEN c_custkey % 7 = 0 THEN 'Nowhere' ELSE 'City ' || "
        f"{text('c_nationkey')} || ',' || CASE WHEN c_custkey % 2 = 0 THEN '  ' ELSE '' END || "
        "c_mktsegment END",
        "birthday": _BIRTHDAY,
        "college": "CASE WHEN c_custkey % 13 = 0 THEN '' ELSE 'College ' || "
        f"{text(whole('c_custkey / 12') + f' + {copy - 1}')} END",
        "current_status": "c_mktsegment",
        "current_team": "CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE 'TEAM_' || "
        f"{text(whole('c_custkey / 14'))} END",
        "experience": text(f"c_custkey % 17 + {copy}"),
        "high_school": "'High ' || c_mktsegment",
        "name": "CASE WHEN c_custkey % 11 = 0 THEN c_name ELSE 'Last' || "
        f"{text('c_custkey')} || ',First' || {text('c_nationkey')} END",
        "number": text("c_custkey % 99"),
        "player_id": f"'x/' || {text('c_custkey')}",
        "position": "c_mktsegment",
        "years_played": text(years),
    }


# Second source of half the raw tables: the same rows with other padding, which dedup merges.
_TWICE = ("passing", "rushing", "defensive")


def raw_selects(category: str) -> list[tuple[str, list[str]]]:
    """(source table, expressions) whose bag union is the raw table."""
    if category == "players":
        parts = [("customer", _players(1)), ("customer", _players(2))]
    else:
        source, own = _SOURCES[category]
        values = {**_COMMON[source], **own}
        parts = [(source, values)]
        if category in _TWICE:
            parts.append((source, {**values, "team": f"' ' || {values['team']} || '  '"}))
    return [
        (
            source,
            [f"{values.get(c, 'CAST(NULL AS STRING)')} AS {c}" for c in RAW_COLUMNS[category]],
        )
        for source, values in parts
    ]


COLLEGE_INTS = ("mean_attendance", "stadium_size")
COLLEGES = (
    "supplier",
    [
        "'College ' || CAST(s_suppkey AS STRING) AS school",
        "'State ' || CAST(s_nationkey AS STRING) AS state",
        "s_name AS city",
        f"{text(whole('s_acctbal'))} AS mean_attendance",
        "CASE WHEN s_suppkey % 9 = 0 THEN 'big' ELSE CAST(s_suppkey * 10 AS STRING) END AS stadium_size",
    ],
)
TEAMS = (
    "supplier",
    [
        "'TEAM_' || CAST(s_suppkey AS STRING) AS team_name",
        "s_name AS home_stadium",
        "'Place ' || CAST(s_nationkey AS STRING) AS location",
        "CAST(s_nationkey * 3 AS STRING) AS lat",
        "CAST(s_nationkey * 5 AS STRING) AS long",
        "s_name AS mascot",
        "CAST(NULL AS STRING) AS live_mascots",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'East' ELSE 'West' END AS conference",
        "CAST(s_suppkey % 4 AS STRING) AS division",
        "CAST(s_suppkey % 7 AS STRING) AS superbowl_wins",
        "CAST(1920 + s_suppkey % 80 AS STRING) AS year_est",
    ],
)


def table(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{source}.parquet")


#: Rows of a task that makes a text table; a source whose row groups are larger is spread first.
TASK_ROWS = 1 << 17

_tasks: dict[tuple[str, str], int | None] = {}
_readers: dict[tuple[str, str], int] = {}


def rows_by_task(rows: DataFrame) -> DataFrame:
    """Rows ``n`` of each task that reads any."""
    return rows.groupBy(F.spark_partition_id()).agg(F.expr("count(*) AS n"))


def tasks_needed(rows: DataFrame, most: int = TASK_ROWS) -> int | None:
    """Tasks over which to spread a table of which one task would read more than ``most`` rows."""
    found = rows_by_task(rows).agg(F.expr("sum(n) AS total"), F.expr("max(n) AS largest")).first()
    return -(-found.total // most) if (found.largest or 0) > most else None


def spread(
    spark: SparkSession, sf_dir: str, source: str, split: int | None = None, row_by_row: bool = False
) -> DataFrame:
    """A source table over ``split`` tasks, by default over those it needs.

    ``row_by_row`` says that no task holds its rows, as they are only parsed and written: a source
    that keeps all cores busy as it is isn't shuffled then.
    """
    rows = table(spark, sf_dir, source)
    if not split:
        key = (spark.sparkContext.applicationId, f"{sf_dir}/{source}")
        if key not in _tasks:
            _tasks[key] = tasks_needed(rows)
        split = _tasks[key]
        if split and row_by_row:
            if key not in _readers:
                _readers[key] = rows_by_task(rows).count()
            if _readers[key] >= 2 * spark.sparkContext.defaultParallelism:
                return rows
    return rows.repartition(split) if split else rows


def derived(
    spark: SparkSession, sf_dir: str, select: tuple[str, list[str]], split: int | None = None
) -> DataFrame:
    """``split`` spreads a source of few files over that many tasks; by default those it needs."""
    source, expressions = select
    return spread(spark, sf_dir, source, split).selectExpr(*expressions)


def derived_sql(select: tuple[str, list[str]]) -> str:
    source, expressions = select
    return f"SELECT {', '.join(expressions)} FROM {source}"


def raw(
    spark: SparkSession, sf_dir: str, category: str, split: int | None = None, row_by_row: bool = False
) -> DataFrame:
    """The raw table. Its selects have one source, which is read once: what they have in common is
    computed once for each of its rows, and the other columns for each select."""
    selects = raw_selects(category)
    (source,) = {s for s, _ in selects}
    rows = spread(spark, sf_dir, source, split, row_by_row)
    if len(selects) == 1:
        return rows.selectExpr(*selects[0][1])
    columns, own, parts = RAW_COLUMNS[category], [], [[] for _ in selects]
    made = []
    for name, *values in zip(columns, *[expressions for _, expressions in selects]):
        if len(set(values)) == 1:
            made.append(values[0])
            continue
        own.append(name)
        for i, value in enumerate(values):
            made.append(f"{value.removesuffix(f' AS {name}')} AS _{i}_{name}")
            parts[i].append(f"'{name}', _{i}_{name}")
    structs = ", ".join(f"named_struct({', '.join(part)})" for part in parts)
    shared = [c for c in columns if c not in own]
    return rows.selectExpr(*made).selectExpr(*shared, f"inline(array({structs}))").select(*columns)


def raw_sql(category: str) -> str:
    return " UNION ALL ".join(derived_sql(s) for s in raw_selects(category))
