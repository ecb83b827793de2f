"""Every registered query against its DuckDB statement on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = driver.library_queries()
ORACLE = driver.library_oracle()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


def ordered(rows):
    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = ordered(df.select(*columns).collect())
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert found == ordered([row[i] for i in places] for row in result.fetchall())
    assert found


def test_every_query_has_its_statement():
    assert set(QUERIES) == set(ORACLE)


def test_queries_hold_those_of_the_library():
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[0] == "player_key" and df.columns[-1] == "copies"
    assert df.count() > 0
