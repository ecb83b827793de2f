import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import bag
from tierflow.operators import (
    career_totals,
    count_copies,
    dense_rank_by,
    fuse_outer,
    fuse_union,
    modal_value,
    modal_value_rows,
    repeat_rows,
    rollup,
    salted_left_join,
    union_columns,
    year_span,
)
from tierflow.specs import ROLLUPS, STAT_CATEGORIES, clean_spec

quick = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def stat_tables(spark, seed):
    """Silver tables of small random-like rows; some keys and years are NULL."""
    tables = {}
    for n, category in enumerate(STAT_CATEGORIES):
        schema = clean_spec(category).silver_schema()
        data = []
        for i in range(40):
            h = (i * 7919 + n * 104729 + seed * 31) % 1009
            row = {
                "player_id": None if h % 11 == 0 else h % 13,
                "year": None if h % 9 == 0 else str(1990 + h % 6),
                "team": None if h % 7 == 0 else f"T{h % 4}",
            }
            for j, f in enumerate(schema):
                if f.name not in row:
                    kind = f.dataType.simpleString()
                    value = (h * (j + 3)) % 50
                    row[f.name] = {"int": value, "float": value / 2, "string": str(value)}[kind]
                    if (h + j) % 10 == 0:
                        row[f.name] = None
            data.append(tuple(row[f.name] for f in schema))
        if (seed + n) % 4 == 0:
            data = data[:3]
        tables[category] = spark.createDataFrame(data, schema)
    return tables


@pytest.mark.parametrize("seed", range(3))
def test_union_form_equals_join_form(spark, seed):
    tables = stat_tables(spark, seed)
    rolled = {c: rollup(t, ROLLUPS[c]) for c, t in tables.items()}
    joined = fuse_outer(rolled)
    assert bag(fuse_union(tables)) == bag(joined.filter("player_id is not null"))
    assert joined.schema.names == fuse_union(tables).schema.names

    keys = joined.select("player_id").distinct()
    for c, r in rolled.items():
        keys = keys.join(r.selectExpr("player_id", f"years as {c}"), "player_id", "left")
    best = ", ".join(f"coalesce({c}, 0)" for c in rolled)
    good = keys.filter("player_id is not null").selectExpr(
        "player_id", f"greatest({best}) as good_years"
    )
    careers = career_totals(tables)
    assert bag(careers.select(*fuse_union(tables).columns)) == bag(fuse_union(tables))
    assert bag(careers.select("player_id", "good_years")) == bag(good)
    spans = year_span(tables.values()).filter("player_id is not null")
    assert bag(careers.select("player_id", "y_min", "y_max")) == bag(spans)


def test_union_form_can_keep_the_null_key(spark):
    tables = stat_tables(spark, 1)
    kept = fuse_union(tables, drop_null_key=False)
    assert kept.filter("player_id is null").count() == 1


def test_union_forms_shuffle_once_or_twice(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    tables = stat_tables(spark, 0)
    plans = [
        form(tables)._jdf.queryExecution().executedPlan().toString()
        for form in (fuse_union, career_totals)
    ]
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 2]
    assert not any("Join" in p for p in plans)


def test_modal_value(rows):
    data = [(1, "A"), (1, "A"), (1, "B"), (2, "B"), (2, "A"), (3, None), (3, "A"), (None, "C")]
    df = rows(data, "k int, v string")
    expected = [(1, 2, "A"), (2, 2, "A"), (3, 2, None), (None, 1, "C")]
    assert bag(modal_value(df, "k", "v")) == sorted(expected, key=repr)
    window = df.groupBy("k", "v").count().selectExpr(
        "k", "first_value(v) over (partition by k order by count desc, v) as v"
    )
    assert bag(modal_value_rows(df, "k", "v")) == bag(window)


@quick
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", "c", None])), min_size=1))
def test_modal_value_like_a_window(spark, data):
    df = spark.createDataFrame(data, "k int, v string")
    window = df.groupBy("k", "v").count().selectExpr(
        "k", "first_value(v) over (partition by k order by count desc, v) as v"
    )
    assert bag(modal_value_rows(df, "k", "v")) == bag(window)


def test_repeat_rows_across_blocks(rows):
    df = rows([("a", 0), ("b", 1), ("c", 4096), ("d", 10001), ("e", None)], "x string, n long")
    found = repeat_rows(df, "n").groupBy("x").count()
    assert dict(map(tuple, found.select("x", "count").collect())) == {"b": 1, "c": 4096, "d": 10001}


def test_count_copies_is_the_inverse(rows):
    df = rows([(1, "a"), (1, "a"), (None, None), (None, None), (2, "b")], "k int, v string")
    assert bag(repeat_rows(count_copies(df), "copies")) == bag(df)


@quick
@given(st.lists(st.integers(-50, 5000), min_size=1, max_size=60))
def test_dense_rank_by(spark, scores):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, s long")
    order = sorted(set(scores), reverse=True)
    expected = [(i, order.index(s) + 1, s) for i, s in enumerate(scores)]
    assert bag(dense_rank_by(df, "s", "place")) == sorted(expected, key=repr)


def test_dense_rank_of_large_scores(rows):
    scores = [2**62, 2**62 - 1, 2**40, 2**40 + 1, 0, 7, 7, None]
    df = rows([(s,) for s in scores], "s long")
    found = {r.s: r.place for r in dense_rank_by(df, "s", "place").collect()}
    assert found == {2**62: 1, 2**62 - 1: 2, 2**40 + 1: 3, 2**40: 4, 7: 5, 0: 6, None: None}


def test_dense_rank_of_negative_and_close_scores(rows):
    scores = [5, 0, -3, -3, 10**9, 10**9 + 1, 10**9 + 2] + [7] * 50
    found = {r.s: r.place for r in dense_rank_by(rows([(s,) for s in scores], "s long"), "s", "place").collect()}
    assert found == {10**9 + 2: 1, 10**9 + 1: 2, 10**9: 3, 7: 4, 5: 5, 0: 6, -3: 7}


def test_salted_join_is_a_left_join(rows, spark):
    left = rows([(i, "hot" if i % 3 else None if i % 2 else f"k{i}") for i in range(200)],
                "i int, k string")
    right = rows([("hot", 1), ("k0", 2), ("k6", 3)], "key string, w int")
    plain = left.join(right, left.k == right.key, "left")
    assert bag(salted_left_join(left, right, "k", "key", ["i"])) == bag(plain)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    salted = salted_left_join(left, right, "k", "key", ["i"])
    parts = {}
    for r in salted.selectExpr("spark_partition_id() p", "k").collect():
        if r.k == "hot":
            parts.setdefault(r.p, 0)
    same = bag(salted) == bag(plain)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert same and len(parts) > 1


def test_union_columns_keeps_duplicates(rows):
    df = rows([(1, 2)], "a int, b int")
    assert bag(union_columns([df, df], ["a"])) == [(1,), (1,)]
