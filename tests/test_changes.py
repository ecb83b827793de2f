"""Fingerprints, multiset differences, partial rewrites and the fact from changes."""

import os
import random

import pytest

from conftest import bag
from test_derive import stat_tables
from tierflow.operators.changes import (
    Fingerprint,
    apply_changes,
    changed_keys,
    fingerprint,
    fingerprints,
    row_changes,
)
from tierflow.plans import build_fact, touched_players, update_fact
from tierflow.plans.incremental import fact_columns
from tierflow.schemas import TEAMS_DIM
from tierflow.sources import read_partitions, refresh_partitions, write_partitions
from tierflow.specs import STAT_CATEGORIES, clean_spec

SCHEMA = "a string, b int, c double"
ROWS = [("x", 1, 0.5), ("x", 1, 0.5), ("y", None, 1.0), (None, 1, None), ("", 2, 2.0)]


def test_order_of_rows_and_columns_does_not_matter(rows):
    df = rows(ROWS, SCHEMA)
    other = rows(list(reversed(ROWS)), SCHEMA).repartition(3).select("c", "a", "b")
    assert fingerprint(df) == fingerprint(other)
    assert fingerprint(df).rows == 5
    assert fingerprint(df.where("false")) == Fingerprint()


@pytest.mark.parametrize("changed", [
    ROWS[1:],  # one of two equal rows less
    [*ROWS, ROWS[0]],
    [*ROWS[:2], ("y", 0, 1.0), *ROWS[3:]],  # NULL is not 0
    [*ROWS[:4], (None, 2, 2.0)],  # nor is an empty text
    [("x", 1, 1.0), ("x", 1, 0.5), ("y", None, 0.5), *ROWS[3:]],  # values that change places
    [("1", 1, 0.5), *ROWS[1:]],
])
def test_other_rows_have_another_fingerprint(rows, changed):
    assert fingerprint(rows(ROWS, SCHEMA)) != fingerprint(rows(changed, SCHEMA))


def test_a_value_under_another_column_is_another_row(rows):
    one = rows([(None, "v")], "a string, b string")
    two = rows([("v", None)], "a string, b string")
    assert fingerprint(one) != fingerprint(two)


def test_fingerprints_of_many_tables_are_those_of_each(rows):
    tables = {"one": rows(ROWS, SCHEMA), "two": rows(ROWS[:2], SCHEMA)}
    found = {r.name: Fingerprint(r.rows, r.total, r.mixed) for r in fingerprints(tables).collect()}
    assert found == {name: fingerprint(df) for name, df in tables.items()}


def test_hashes_that_pass_the_range_of_bigint_add_up(spark):
    df = spark.range(200_000)
    assert fingerprint(df.union(df)).rows == 400_000


def test_row_changes_by_counting(rows):
    rng = random.Random(3)
    for _ in range(4):
        sides = [
            [(rng.choice("ab") if rng.random() < 0.8 else None, rng.randrange(3)) for _ in range(rng.randrange(1, 30))]
            for _ in range(2)
        ]
        old, new = (rows(s, "a string, b int") for s in sides)
        expected = [
            (*r, sides[1].count(r) - sides[0].count(r))
            for r in set(sides[0] + sides[1]) if sides[1].count(r) != sides[0].count(r)
        ]
        changes = row_changes(old, new)
        assert bag(changes) == sorted(expected, key=repr)
        counted = {tuple(r)[:2]: r.n for r in apply_changes(old, changes).collect()}
        assert counted == {r: sides[1].count(r) for r in sides[1]}


def test_changed_keys(rows):
    old = rows([("1", 1), ("1", 2), ("2", 1), (None, 5), ("3", 3)], "k string, v int")
    new = rows([("1", 2), ("1", 1), ("2", 7), (None, 6), ("4", 4)], "k string, v int")
    found = {r.k: (r.in_old, r.in_new) for r in changed_keys(old, new, "k").collect()}
    assert found == {"2": (True, True), None: (True, True), "3": (True, False), "4": (False, True)}
    assert changed_keys(old, old.orderBy("v"), "k").isEmpty()


# Partitions.


def files_of(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def test_only_changed_partitions_are_written(spark, rows, tmp_path):
    schema = "n int, year string, team string"
    path = str(tmp_path / "t")
    old = rows([(1, "2000", "A"), (2, "2001", "A"), (3, "2002", "B"), (4, None, "C"), (5, "a b/c=d", "E")], schema)
    assert refresh_partitions(old, path, old.schema)["written"]
    assert bag(read_partitions(spark, old.schema, path)) == bag(old)
    before = files_of(path)
    new = rows([(1, "2000", "A"), (7, "2001", "A"), (4, None, "C"), (8, "2003", "B")], schema)
    changed = refresh_partitions(new, path, old.schema)
    assert changed == {"written": ["2001", "2003"], "deleted": ["2002", "a b/c=d"]}
    found = read_partitions(spark, old.schema, path)
    assert bag(found) == bag(new) and found.columns == ["n", "year", "team"]
    after = files_of(path)
    same = [f for f in before if "year=2000" in f or "HIVE_DEFAULT" in f]
    assert len(same) == 2 and all(after[f] == before[f] for f in same)
    assert refresh_partitions(new, path, old.schema) == {"written": [], "deleted": []}
    assert files_of(path) == after


def test_filters_by_year_skip_folders(spark, rows, tmp_path):
    df = rows([(n, str(2000 + n)) for n in range(5)], "n int, year string")
    write_partitions(df, str(tmp_path / "t"))
    found = read_partitions(spark, df.schema, str(tmp_path / "t")).where("year = '2003'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert [r.n for r in found.collect()] == [3] and len(found.inputFiles()) == 5
    assert found.select("_metadata.file_path").distinct().count() == 1


# The fact from changes.


def people(spark, data):
    schema = clean_spec("players").silver_schema()
    values = [
        tuple({"player_id": p, "college": c, "current_team": t}.get(f.name) for f in schema)
        for p, c, t in data
    ]
    return spark.createDataFrame(values, schema)


def dims(spark, schools, clubs):
    colleges = spark.createDataFrame([(s, "S") for s in schools], "school string, state string")
    names = spark.createDataFrame([tuple(c if f == "team_name" else "x" for f in TEAMS_DIM.names) for c in clubs], TEAMS_DIM)
    return colleges, names


def random_silver(spark, rng, players):
    """Silver tables of some players, with repeated rows, missing values and several teams."""
    tables = stat_tables(spark, 1)
    out = {}
    for category in STAT_CATEGORIES:
        schema = tables[category].schema
        data = []
        for p in players:
            for _ in range(rng.randrange(0, 4)):
                values = {
                    "player_id": p, "year": str(rng.randrange(2000, 2004)),
                    "team": rng.choice(["T1", "T2", "T3", None]),
                }
                row = tuple(
                    values.get(f.name, {"string": "s", "int": rng.randrange(5), "float": float(rng.randrange(5))}.get(f.dataType.simpleString()))
                    for f in schema
                )
                data += [row] * rng.choice([1, 1, 2])
        out[category] = spark.createDataFrame(data, schema)
    people_rows = [
        (p, rng.choice(["C1", "C2", None]), rng.choice(["T1", "T9", None]))
        for p in players for _ in range(rng.choice([1, 1, 2]))
    ]
    out["players"] = people(spark, people_rows)
    return out


def settle(tables, folder):
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
    return {name: df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}") for name, df in tables.items()}


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("seed, rows", [(1, "counted"), (2, "single"), (3, "repeated")])
def test_update_is_the_whole_fact(spark, tmp_path, seed, rows):
    rng = random.Random(seed)
    stay = random_silver(spark, random.Random(seed + 100), range(1, 12))
    old_only, new_only = (random_silver(spark, rng, ids) for ids in (range(12, 18), range(15, 21)))
    old = settle({c: stay[c].unionByName(old_only[c]) for c in stay}, str(tmp_path / "old"))
    new = settle({c: stay[c].unionByName(new_only[c]) for c in stay}, str(tmp_path / "new"))
    colleges, clubs = dims(spark, ["C1", "C2", "C2"], ["T1", "T2"])
    fact = settle({"f": build_fact(old, colleges, clubs, rows)}, str(tmp_path / "fact"))["f"]
    updated = update_fact(fact, old, new, colleges, clubs, str(tmp_path / "scratch"), rows)
    whole = build_fact(new, colleges, clubs, rows)
    assert same(updated, whole)
    touched = {r.player_id for r in spark.read.parquet(str(tmp_path / "scratch/touched")).collect()}
    assert touched <= set(range(12, 21)) and {12, 13, 14} & touched


def test_a_dimension_that_changes_touches_its_players(spark, tmp_path):
    silver = settle(random_silver(spark, random.Random(8), range(1, 15)), str(tmp_path / "s"))
    old_colleges, old_clubs = dims(spark, ["C1"], ["T1", "T2"])
    colleges, clubs = dims(spark, ["C1", "C2"], ["T1", "T1", "T3"])
    fact = settle({"f": build_fact(silver, old_colleges, old_clubs)}, str(tmp_path / "fact"))["f"]
    keys = {
        "college": (old_colleges.select("school"), colleges.select("school")),
        "team": (old_clubs.select("team_name"), clubs.select("team_name")),
    }
    updated = update_fact(fact, silver, silver, colleges, clubs, str(tmp_path / "x"), dimensions=keys)
    assert same(updated, build_fact(silver, colleges, clubs))
    assert not same(fact, updated)


def test_columns_that_the_fact_does_not_read_touch_nobody(spark):
    silver = random_silver(spark, random.Random(5), range(1, 6))
    other = {c: t.withColumn("last_name", t["last_name"]) for c, t in silver.items()}
    other["kicking"] = other["kicking"].selectExpr(*[
        "'new' AS last_name" if c == "last_name" else c for c in other["kicking"].columns
    ])
    assert touched_players(silver, other).isEmpty()
    assert "last_name" not in fact_columns("kicking")
