"""Joins that salt only hot keys, tables in buckets, and cleaning that counts what it drops."""

import random
import re
import uuid

import pytest

from conftest import bag
from test_changes import dims, random_silver, same, settle
from test_derive import stat_tables
from test_refresh import rushing
from tierflow.operators import careers_with_team, refine
from tierflow.operators.join import (
    copies_of_hot,
    hot_keys,
    hot_left_join,
    salted_left_join,
)
from tierflow.plans import build_fact, bucketed_fact, save_fact_tables, write_refined
from tierflow.plans.bucketed import colocated_careers, save_bucketed
from tierflow.schemas import RAW_COLUMNS, raw_schema
from tierflow.specs import clean_spec


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=30_000):
    """A third of the rows have one key, a seventh none, the others are spread."""
    return spark.range(n).selectExpr(
        "id", "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 997) END AS k"
    )


def test_hot_keys_are_found(spark):
    df = skewed(spark)
    found = df.limit(1).select(hot_keys(df, "k").alias("h")).first().h
    assert found == ["hot"]
    assert spark.range(1).select(hot_keys(df.where("false"), "k").alias("h")).first().h == []
    even = spark.range(10_000).selectExpr("concat('k', id % 1000) AS k")
    assert spark.range(1).select(hot_keys(even, "k").alias("h")).first().h == []


@pytest.mark.parametrize("share", [1 / 8, 1 / 64])
def test_every_key_above_the_share_is_found(spark, share):
    rng = random.Random(2)
    values = [f"v{min(int(rng.paretovariate(0.6)), 3000)}" for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "k string").repartition(7)
    found = spark.range(1).select(hot_keys(df, "k", share).alias("h")).first().h
    assert {v for v in set(values) if values.count(v) >= share * len(values)} <= set(found)
    assert len(found) <= 2 / share


def test_join_is_the_plain_one_and_few_rows_are_copied(spark):
    df = skewed(spark)
    side = spark.range(997).selectExpr("concat('k', id) AS s", "id * 2 AS v").union(
        spark.createDataFrame([("hot", -1), ("hot", -2), (None, 5)], "s string, v long")
    )
    joined = hot_left_join(df, side, "k", "s", ["id"])
    assert same(joined, df.join(side, df["k"] == side["s"], "left"))
    assert same(joined, salted_left_join(df, side, "k", "s", ["id"]))
    # copies: eight of each of the two hot rows, one of all others
    plan = hot_left_join(df, side, "k", "s", ["id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert same(plan, df.join(side, df["k"] == side["s"], "left"))
        rows = hot_left_join(df, side, "k", "s", ["id"], source=df.select("k"))
        assert rows.where("k = 'hot'").groupBy().count().first()[0] == 2 * df.where("k = 'hot'").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copies_are_bounded_by_hot_keys(spark):
    df = skewed(spark)
    side = spark.range(997).selectExpr("concat('k', id) AS s").union(
        spark.createDataFrame([("hot",), ("hot",), (None,)], "s string")
    )
    copied = copies_of_hot(side, hot_keys(df, "k"), "s", 8)
    assert copied.count() == side.count() + 7 * 2
    assert copied.where("s = 'hot'").count() == 16 and copied.where("s <> 'hot'").count() == 997


def test_fact_with_hot_lookups_is_the_same(spark):
    silver = random_silver(spark, random.Random(4), range(1, 20))
    colleges, clubs = dims(spark, ["C1", "C2", "C2"], ["T1", "T2", "T2"])
    assert same(
        build_fact(silver, colleges, clubs), build_fact(silver, colleges, clubs, lookups="hot")
    )
    with pytest.raises(ValueError, match="lookups"):
        build_fact(silver, colleges, clubs, lookups="x")


# Buckets.


@pytest.fixture
def tables(spark, tmp_path):
    def make(silver):
        prefix = f"t_{uuid.uuid4().hex}"
        return save_fact_tables(spark, silver, prefix, 4, str(tmp_path / prefix))

    return make


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bucketed_fact_is_the_same(spark, tables, seed):
    silver = random_silver(spark, random.Random(seed), range(1, 25))
    colleges, clubs = dims(spark, ["C1", "C2", "C2"], ["T1", "T2"])
    assert same(
        bucketed_fact(tables(silver), colleges, clubs), build_fact(silver, colleges, clubs)
    )


def test_careers_from_buckets_are_the_same(spark, tables):
    silver = random_silver(spark, random.Random(6), range(1, 15))
    silver |= {c: t for c, t in stat_tables(spark, 2).items()}  # NULL keys, years and teams
    stats = {c: t for c, t in silver.items() if c != "players"}
    careers = careers_with_team(stats)
    known = silver["players"].select("player_id").distinct()
    assert same(colocated_careers(tables(silver)), careers.join(known, "player_id"))


def test_no_player_is_shuffled(spark, tables, tmp_path):
    silver = random_silver(spark, random.Random(1), range(1, 10))
    stored = tables(silver)
    # files, whose size Spark knows
    found = settle(dict(zip("ct", dims(spark, ["C1"], ["T1"]))), str(tmp_path / "dims"))
    colleges, clubs = found["c"], found["t"]
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    spark.conf.set(keys[1], "false")
    try:
        spark.conf.set(keys[0], "-1")
        assert "Exchange" not in plan_of(colocated_careers(stored))
        spark.conf.unset(keys[0])
        # dimensions are small here: nothing but them moves, and rows are merged within a bucket
        plan = plan_of(bucketed_fact(stored, colleges, clubs, salts=1))
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert not [k for k in re.findall(r"Exchange hashpartitioning\(([^)]*)", plan) if "player" in k]


def test_buckets_are_one_file_each(spark, tmp_path):
    df = spark.range(1000).selectExpr("CAST(id % 50 AS int) AS player_id", "id")
    table = save_bucketed(df, f"b_{uuid.uuid4().hex}", 5, location=str(tmp_path / "b"))
    assert len(table.inputFiles()) == 5 and bag(table) == bag(df)


# Counts of what is dropped.


def test_counts_of_a_cleaning_job(spark, tmp_path):
    df = rushing(spark, [1000, 999, "1,500", "many", "--", 2000])
    df = df.union(df.limit(1))
    counts = write_refined(df, clean_spec("rushing"), str(tmp_path / "s"))
    assert bag(spark.read.parquet(str(tmp_path / "s"))) == bag(refine(df, clean_spec("rushing")))
    assert counts["rows_in"] == 7 and counts["rows_distinct"] == 6
    assert counts["kept"] == 3 and counts["fails_keep"] == 3
    assert counts["unparsed_rushing_yards"] == 1 and counts["unparsed_player_id"] == 0
    assert counts["fails_year"] == counts["fails_first_name"] == 0


@pytest.mark.parametrize("category", RAW_COLUMNS)
def test_the_table_is_read_once(spark, tmp_path, category):
    raw = str(tmp_path / "raw")
    names = RAW_COLUMNS[category]
    values = [tuple(f"{c[:1]}/{i}, x" for c in names) for i in range(30)]
    spark.createDataFrame(values, raw_schema(category)).write.parquet(raw)
    df = spark.read.schema(raw_schema(category)).parquet(raw)
    from pyspark.sql import Observation

    from tierflow.operators.refine import refine_observed

    seen, parsed = Observation(), Observation()
    observed = refine_observed(df, clean_spec(category), seen, parsed)
    assert plan_of(observed).count("FileScan") == 1
    assert bag(observed) == bag(refine(df, clean_spec(category)))
    assert seen.get == {"rows_in": 30} and parsed.get["rows_distinct"] == 30
    with pytest.raises(ValueError, match="missing"):
        refine_observed(df.drop("player_id"), clean_spec(category), Observation(), Observation())
