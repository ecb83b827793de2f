import itertools

import pytest

from conftest import bag
from test_derive import stat_tables
from tierflow.operators import career_totals, careers_with_team, repeat_rows, union_columns
from tierflow.plans import (
    backfill_max,
    backfill_null_only,
    build_fact,
    college_dim,
    college_ranking,
    college_scores,
    describe,
    gate_report,
    match_audit,
    match_summary,
    player_teams,
    players_dim,
    positions_dim,
    preview,
    should_refresh,
    teams_dim,
    view_counts,
)
from tierflow.operators import modal_value
from tierflow.plans.star import main_position
from tierflow.schemas import FACT_MEASURES, TEAMS_DIM, fact_schema
from tierflow.specs import ROLLUPS, clean_spec

FACT = fact_schema()


def people(spark, data):
    """Silver players from (player_id, college, current_team)."""
    schema = clean_spec("players").silver_schema()
    values = [
        tuple({"player_id": p, "college": c, "current_team": t}.get(f.name) for f in schema)
        for p, c, t in data
    ]
    return spark.createDataFrame(values, schema)


def seasons(spark, category, data):
    """Silver rows of a category from dicts."""
    schema = clean_spec(category).silver_schema()
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in data], schema)


def small_star(spark):
    """Two players whose facts are worked out by hand below, and one without a players row."""
    silver = {c: seasons(spark, c, []) for c in ROLLUPS}
    silver["rushing"] = seasons(spark, "rushing", [
        {"player_id": 1, "team": "T1", "year": "2001", "rushing_yards": 10, "rushing_tds": 1},
        {"player_id": 1, "team": "T1", "year": "2002", "rushing_yards": 20, "rushing_tds": None},
        {"player_id": 1, "team": "T2", "year": "2002", "rushing_yards": 5, "rushing_tds": 2},
        {"player_id": 3, "team": "T1", "year": "2002", "rushing_yards": 5},
        {"player_id": None, "team": "T1", "year": "2002", "rushing_yards": 7},
    ])
    silver["kicking"] = seasons(spark, "kicking", [
        {"player_id": 1, "team": None, "year": "1999", "fgs_made": 3},
        {"player_id": 2, "team": None, "year": None, "fgs_made": 30},
    ])
    silver["players"] = people(spark, [
        (1, "A", None), (1, "B", "T2"), (2, None, None), (9, "A", "T1"), (None, "A", "T1"),
    ])
    colleges = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "school string")
    teams = spark.createDataFrame([("T1",), ("T2",)], "team_name string")
    return silver, colleges, teams


@pytest.fixture
def star(spark):
    silver = stat_tables(spark, 2)
    silver["players"] = people(spark, [
        (0, "A", "T1"), (0, "B", None), (1, None, None), (2, "X", "T9"), (3, "A", None),
        (3, "A", None), (4, "B", "T2"), (5, "A", None), (99, "A", "T1"), (None, "A", None),
    ])
    colleges = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "school string")
    teams = spark.createDataFrame([("T1",), ("T2",), ("T0",)], "team_name string")
    return silver, colleges, teams


def test_fact_by_hand(spark):
    """Player 1: 2 players rows, teams NULL, T1 (most often) and T2, so n * n * t = 12 rows.

    By college and team: A and T1 (usual), A and T2, and the same for B, which the dimension
    holds twice. Each pair counts 1 * 1 * 3 rows, doubled for B.
    """
    totals = {"rushing_yards": 35, "rushing_tds": 3, "fgs_made": 3}
    first = {"player_key": 1, "position_key": 2, "years_played": "1999-2002", "good_years": 2, **totals}
    second = {"player_key": 2, "position_key": 6, "years_played": "-", "good_years": 0, "fgs_made": 30}
    expected = [
        {**first, "college_key": college, "team_key": team, "copies": copies}
        for college, copies in (("A", 3), ("B", 6))
        for team in ("T1", "T2")
    ] + [{**second, "college_key": None, "team_key": None, "copies": 1}]
    found = [r.asDict() for r in build_fact(*small_star(spark)).collect()]
    blank = {m: 0 for m in FACT_MEASURES}
    order = lambda r: (r["player_key"], str(r["college_key"]), str(r["team_key"]))
    assert sorted(found, key=order) == [{**blank, **r} for r in sorted(expected, key=order)]


def test_single_row_takes_the_known_college(spark):
    silver, colleges, teams = small_star(spark)
    silver["players"] = people(spark, [(1, None, "T9"), (1, "B", None), (2, None, "T2"), (2, None, None)])
    found = {r.player_key: (r.college_key, r.team_key) for r in build_fact(
        silver, colleges, teams, rows="single").collect()}
    assert found == {1: ("B", "T1"), 2: (None, "T2")}


def test_forms_agree(spark, star):
    counted = build_fact(*star, rows="counted")
    assert bag(repeat_rows(counted, "copies")) == bag(build_fact(*star, rows="repeated"))
    assert counted.count() == counted.drop("copies").distinct().count()
    assert bag(build_fact(*star, salts=1)) == bag(counted)


def test_careers_and_team_in_one_pass(spark, star):
    stats = {c: star[0][c] for c in ROLLUPS}
    both = careers_with_team(stats)
    rows = union_columns(stats.values(), ["player_id", "team"]).filter("player_id is not null")
    usual = modal_value(rows, "player_id", "team")
    plain = career_totals(stats).join(usual, "player_id")
    assert bag(both) == bag(plain.select(*both.columns))


def test_fact_reads_each_table_once(spark, tmp_path, star):
    silver, colleges, teams = star
    stored = {}
    for name, df in {**silver, "colleges": colleges, "teams": teams}.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.schema(df.schema).parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fact = build_fact({c: stored[c] for c in silver}, stored["colleges"], stored["teams"])
        plan = fact._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # six silver tables, players, and both dimensions; the second count of the players reuses
    # the first one's shuffle
    assert plan.count("FileScan parquet") <= 10
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") <= 15


def test_fact_schema_and_single_rows(star):
    plain = build_fact(*star, rows="repeated")
    assert plain.schema.simpleString() == FACT.simpleString()
    single = build_fact(*star, rows="single")
    keys = [r.player_key for r in single.collect()]
    assert sorted(keys) == [0, 1, 2, 3, 4, 5]
    wide = build_fact(*star, rows="counted", measure_type="bigint")
    assert dict(wide.dtypes)["passing_yards"] == "bigint"
    with pytest.raises(ValueError):
        build_fact(*star, rows="many")


def test_multiplicity(spark):
    """n players rows and t teams give n * n * t fact rows."""
    schema = clean_spec("rushing").silver_schema()
    names = ["A", "B", "C"]
    for n, t in [(1, 1), (1, 2), (2, 3)]:
        silver = {
            c: spark.createDataFrame([], clean_spec(c).silver_schema()) for c in ROLLUPS
        }
        seasons = [
            tuple({"player_id": 1, "team": team, "year": "2000"}.get(f.name) for f in schema)
            for team in names[:t]
        ]
        silver["rushing"] = spark.createDataFrame(seasons, schema)
        silver["players"] = people(spark, [(1, "A", None)] * n)
        dims = [spark.createDataFrame([], s) for s in ("school string", "team_name string")]
        assert build_fact(silver, *dims, rows="repeated").count() == n * n * t
        assert build_fact(silver, *dims, rows="single").count() == 1


def test_position(rows):
    names = [m for m in FACT_MEASURES]
    cases = [
        ({"passing_yards": 5, "rushing_yards": 5}, 1),
        ({"rushing_yards": 6, "passing_yards": 5}, 2),
        ({"receiving_yards": 2}, 3),
        ({"sacks": 2.5, "ints": 2}, 4),
        ({"ints": 3, "sacks": 2.5}, 5),
        ({"fgs_made": 3}, 6),
        ({"kick_return_tds": 2, "punt_return_tds": 1}, 7),
        ({"total_tackles": 150.0}, 1),
        ({"kick_return_tds": 2, "fgs_made": 2}, 6),
    ]
    kinds = {m: "double" if m in ("sacks", "total_tackles") else "long" for m in names}
    data = [
        (i, *[(float if kinds[m] == "double" else int)(c.get(m, 0)) for m in names])
        for i, (c, _) in enumerate(cases)
    ]
    df = rows(data, "i int, " + ", ".join(f"{m} {kinds[m]}" for m in names))
    found = df.orderBy("i").selectExpr(f"{main_position()} as p").collect()
    assert [r.p for r in found] == [p for _, p in cases]


def fact_rows(spark, data):
    """Fact from (player_key, college_key, team_key)."""
    values = [
        tuple({"player_key": p, "college_key": c, "team_key": t}.get(f.name) for f in FACT)
        for p, c, t in data
    ]
    return spark.createDataFrame(values, FACT)


REPAIR = [(1, None, "x"), (1, None, "x"), (1, "A", "x"), (2, "B", "y"), (3, None, "z"), (4, None, "w")]


def test_backfill_null_only(spark):
    fact = fact_rows(spark, REPAIR)
    players = people(spark, [(1, "P", None), (1, "Q", None), (2, "R", None), (3, None, None)])
    fix = (
        fact.filter("college_key is null").select("player_key")
        .join(players, players.player_id == fact.player_key)
        .selectExpr("player_key as k", "college as c")
    )
    rest = [c for c in FACT.names if c not in ("player_key", "college_key")]
    plain = fact.join(fix, fact.player_key == fix.k, "left").selectExpr(
        "player_key", "coalesce(c, college_key) as college_key", *rest
    )
    assert bag(backfill_null_only(fact, players)) == bag(plain)
    counted = backfill_null_only(fact.selectExpr("*", "1L as copies"), players)
    assert bag(repeat_rows(counted, "copies")) == bag(plain)


def test_backfill_of_single_rows(spark):
    fact = fact_rows(spark, [(1, None, "x"), (2, "B", "y"), (3, None, "z")])
    players = people(spark, [(1, "P", None), (1, "Q", None), (1, None, None), (2, "R", None)])
    found = backfill_null_only(fact, players, unique=True)
    assert found.columns == FACT.names
    keys = {r.player_key: r.college_key for r in found.collect()}
    assert found.count() == 3 and keys == {1: "Q", 2: "B", 3: None}


def test_backfill_max(spark):
    fact = fact_rows(spark, REPAIR)
    players = people(spark, [(1, "P", None), (1, "Q", None), (2, None, None), (None, "Z", None)])
    expected = sorted(
        [(1, "Q"), (1, "Q"), (1, "Q"), (2, "B"), (3, None), (4, None)], key=repr
    )
    found = backfill_max(fact, players)
    assert found.columns == FACT.names
    assert sorted(((r.player_key, r.college_key) for r in found.collect()), key=repr) == expected
    counted = backfill_max(fact.selectExpr("*", "1L as copies"), players)
    assert bag(repeat_rows(counted, "copies")) == bag(found)
    unique = backfill_max(fact, players, unique=True)
    assert bag(unique) == bag(found)


def test_dimensions(spark, star):
    assert [r.difficulty for r in positions_dim(spark).orderBy("position_key").collect()] == [
        10, 8, 6, 7, 8, 5, 9,
    ]
    dim = players_dim(star[0]["players"])
    assert dim.columns == "player_key first_name last_name city state current_status".split()
    raw = spark.createDataFrame([("12", "A", "x", "y 1")],
                                "seats string, school string, size string, `odd name` string")
    dim = college_dim(raw, int_columns=["seats", "size"])
    assert dim.columns == ["school", "seats", "size", "odd name"]
    assert tuple(dim.first()) == ("A", 12, None, "y 1")
    teams = spark.createDataFrame([tuple("abcdefghijk")], TEAMS_DIM)
    assert teams_dim(teams).columns == TEAMS_DIM.names


def test_player_teams(spark, star):
    usual = modal_value(union_columns([star[0][c] for c in ROLLUPS], ["player_id", "team"]),
                        "player_id", "team")
    found = player_teams(star[0]["players"], usual)
    lookup = {r.player_id: r.team for r in usual.collect()}
    expected = [
        (t or (lookup.get(p) if p is not None else None), p)
        for p, _, t in [(r.player_id, 0, r.current_team) for r in star[0]["players"].collect()]
    ]
    assert bag(found) == sorted(expected, key=repr)


def test_ranking(spark):
    data = [(1, "A", 1, 3), (1, "A", 1, 3), (2, "A", 6, 2), (3, "B", 7, 4), (4, "C", 2, 5), (5, None, 1, 9)]
    fact = spark.createDataFrame(
        data, "player_key int, college_key string, position_key int, good_years int"
    )
    found = {r.college_key: tuple(r)[1:] for r in college_ranking(college_scores(fact, positions_dim(spark))).collect()}
    assert found == {"A": (2, 5, 40, 1), "B": (1, 4, 36, 2), "C": (1, 5, 40, 1)}


def test_audits(spark, star):
    silver, colleges, _ = star
    plain = silver["players"].join(colleges, silver["players"].college == colleges.school, "left")
    expected = plain.select("player_id", "college", "school").orderBy("player_id", "college", "school")
    found = match_audit(silver["players"], colleges, 4).collect()
    assert found == expected.limit(4).collect()
    summary = {r.matched: r.c for r in match_summary(silver["players"], colleges).collect()}
    assert summary == {True: 8, False: 2}
    counts = view_counts({"a": silver["players"], "b": colleges})
    assert {r.vw: r.c for r in counts.collect()} == {"a": 10, "b": 4}


def test_preview_and_describe(spark, capsys):
    preview({"few": spark.range(2).toDF("k")})
    shown = capsys.readouterr().out
    assert shown.startswith("few\n") and "k: long" in shown and "|1  |" in shown
    spark.range(1).toDF("k").write.saveAsTable("described")
    found = {r.col_name: r.data_type for r in describe(spark, "described").collect()}
    assert found["k"] == "bigint" and "parquet" in found["Provider"]
    spark.sql("DROP TABLE described")


def test_gate(spark):
    small, large = spark.range(2), spark.range(3)
    report = gate_report(
        {"larger": (small, large), "smaller": (large, small), "equal": (small, small),
         "missing": (small, None)}
    )
    found = {r.name: (r.raw_rows, r.snapshot_rows, r.refresh) for r in report.collect()}
    assert found == {
        "larger": (2, 3, True), "smaller": (3, 2, False), "equal": (2, 2, False),
        "missing": (2, 0, False),
    }
    for (a, b), want in zip(itertools.product((1, 2), repeat=2), (False, True, False, False)):
        assert should_refresh(a, b) is want
