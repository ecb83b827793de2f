import os

import pytest

from conftest import bag
from tierflow.operators import refine
from tierflow.plans import BatchConfig, refresh_category, run_batch
from tierflow.schemas import FACT_MEASURES, RAW_COLUMNS, TEAMS_DIM, fact_schema, raw_schema
from tierflow.settings import tune
from tierflow.sources import delete, read_silver
from tierflow.specs import clean_spec


def rushing(spark, yards, tackles=None):
    names = RAW_COLUMNS["rushing"]
    values = [
        tuple(
            {"player_id": f"p/{i}", "name": "A, B", "year": "2000", "team": "T1",
             "rushing_yards": str(y)}.get(c)
            for c in names
        )
        for i, y in enumerate(yards)
    ]
    return spark.createDataFrame(values, raw_schema("rushing"))


def folders(tmp_path):
    return [str(tmp_path / name) for name in ("raw", "snapshot", "silver")]


@pytest.mark.parametrize("snapshot, fresh", [
    (None, False), ([1500], False), ([2000, 3000], False), ([2000, 3000, 10], True),
])
def test_refresh_category(spark, tmp_path, snapshot, fresh):
    raw, inc, silver = folders(tmp_path)
    old = rushing(spark, [1000, 1200])
    old.write.parquet(raw)
    refine(old, clean_spec("rushing")).write.parquet(silver)
    if snapshot is not None:
        rushing(spark, snapshot).write.parquet(inc)
    assert refresh_category(spark, "rushing", raw, inc, silver) is fresh
    yards = sorted(r.rushing_yards for r in spark.read.parquet(silver).collect())
    assert yards == ([2000, 3000] if fresh else [1000, 1200])
    assert spark.read.parquet(raw).count() == (3 if fresh else 2)
    if fresh:
        assert refresh_category(spark, "rushing", raw, inc, silver) is False


def test_missing_raw_table_is_an_error(spark, tmp_path):
    raw, inc, silver = folders(tmp_path)
    rushing(spark, [1]).write.parquet(inc)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        refresh_category(spark, "rushing", raw, inc, silver)


def test_refresh_uses_the_incremental_rules(spark, tmp_path):
    raw, inc, silver = folders(tmp_path)
    names = RAW_COLUMNS["defensive"]
    row = {"player_id": "1", "name": "A, B", "total_tackles": "50", "sacks": "12"}
    high = {**row, "total_tackles": "100", "sacks": None}
    data = [tuple(r.get(c) for c in names) for r in (row, high)]
    spark.createDataFrame(data[:1], raw_schema("defensive")).write.parquet(raw)
    spark.createDataFrame(data, raw_schema("defensive")).write.parquet(inc)
    assert refresh_category(spark, "defensive", raw, inc, silver)
    found = read_silver(spark, clean_spec("defensive"), silver).collect()
    assert [r.total_tackles for r in found] == [100.0]


def test_unfinished_snapshot_counts_as_missing(spark, tmp_path):
    raw, inc, silver = folders(tmp_path)
    rushing(spark, [1000]).write.parquet(raw)
    rushing(spark, [2000, 3000]).write.parquet(inc)
    delete(spark, f"{inc}/_SUCCESS")
    assert refresh_category(spark, "rushing", raw, inc, silver) is False


def test_first_load_of_single_rows_keeps_one_row(spark, tmp_path):
    config = BatchConfig(
        *[str(tmp_path / n) for n in ("raw", "snapshot", "silver", "gold")], fact_rows="single"
    )
    people = [
        {"player_id": "x/0", "birthday": "1/2/1990", "name": "A,B", "years_played": str(i), "college": c}
        for i, c in enumerate(("Home A", "Home B"))
    ]
    for category in RAW_COLUMNS:
        rows = [tuple(p.get(n) for n in RAW_COLUMNS[category]) for p in people]
        data = {"rushing": rushing(spark, [2000]).collect(), "players": rows}.get(category, [])
        spark.createDataFrame(data, raw_schema(category)).write.parquet(config.of("raw", category))
    colleges = spark.createDataFrame([("Yale",)], "school string")
    teams = spark.createDataFrame([("T1", *[None] * 10)], TEAMS_DIM)
    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    for first in (True, False):
        run_batch(spark, config, colleges, teams, first=first)
        found = spark.read.orc(config.of("gold", "fact_player_stats")).collect()
        assert [(r.player_key, r.college_key) for r in found] == [(0, "Home B")]
    assert set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) == before


@pytest.mark.parametrize("fact_rows", ["repeated", "counted", "single"])
def test_run_batch(spark, tmp_path, fact_rows):
    config = BatchConfig(
        *[str(tmp_path / n) for n in ("raw", "snapshot", "silver", "gold")], fact_rows=fact_rows
    )
    for category in RAW_COLUMNS:
        data = []
        if category == "rushing":
            data = rushing(spark, [2000, 1500]).collect()
        if category == "players":
            person = {"birthday": "1/2/1990", "name": "A,B", "years_played": "2"}
            data = [
                tuple({**person, "player_id": f"x/{i}", "college": c}.get(n) for n in RAW_COLUMNS[category])
                for i, c in ((0, "Yale"), (1, "Home school"))
            ]
        spark.createDataFrame(data, raw_schema(category)).write.parquet(config.of("raw", category))
    colleges = spark.createDataFrame(
        [("Yale", "CT", "NH", "1", "2")],
        "school string, state string, city string, seats string, size string",
    )
    teams = spark.createDataFrame([("T1", *[None] * 10)], TEAMS_DIM)

    def gold(name):
        return spark.read.orc(config.of("gold", name))

    changed = run_batch(spark, config, colleges, teams, first=True)
    assert all(changed.values())
    fact = gold("fact_player_stats")
    expected = [(0, "Yale", "T1", 2, 2000), (1, "Home school", "T1", 2, 1500)]
    columns = ["player_key", "college_key", "team_key", "position_key", "rushing_yards"]
    assert [tuple(r) for r in fact.select(columns).orderBy("player_key").collect()] == expected
    if fact_rows != "counted":
        assert fact.columns == fact_schema().names
    assert gold("positions_dim").count() == 7 and gold("players_dim").count() == 2

    rushing(spark, [2000, 1500, 1]).selectExpr(
        "* except (rushing_yards)", "'3,000' as rushing_yards"
    ).select(*RAW_COLUMNS["rushing"]).write.parquet(config.of("snapshot", "rushing"))
    changed = run_batch(spark, config, colleges, teams)
    assert [c for c, done in changed.items() if done] == ["rushing"]
    fact = gold("fact_player_stats")
    assert [r.rushing_yards for r in fact.collect()] == [3000, 3000]
    assert bag(gold("positions_dim")) == bag(gold("positions_dim").distinct())
    assert set(FACT_MEASURES) < set(fact.columns)


def test_tune_respects_the_users_value(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, "65535")
    tune(spark)
    assert spark.conf.get(name) == "8000"
    spark.conf.set(name, "9000")
    tune(spark)
    assert spark.conf.get(name) == "9000"
    spark.conf.unset(name)
