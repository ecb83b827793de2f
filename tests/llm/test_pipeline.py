import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from llm.test_packing import check
from llm.test_rules import prose

SF_DIR = "/root/testdata/sf0.001"
TABLES = {
    "op4_quotation_links": "conversations", "op9_html_text": "pages", "op8_decontamination": None,
    "op2_packing": None, "op13_spelling_variants": None, "pipeline": None,
}


@pytest.fixture
def folder(spark, tmp_path):
    """Clean documents, junk, copies, contaminated ones and one with a secret."""
    item = prose(901, 30)
    rows = [(i, prose(i)) for i in range(1, 81)]
    rows += [(100, None), (101, "too short"), (102, " ".join(f"{w}###" for w in prose(7).split()))]
    rows += [(110, prose(5)), (111, prose(5) + " more"), (5, prose(5))]
    rows += [(120, prose(902, 90) + " " + item + " " + prose(903, 90)), (120, prose(950))]
    rows += [(130, prose(904) + " token = abcdefgh12345 " + prose(905))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars", "'k' AS key", "1 AS kept",
        "'x' AS text_key", "2 AS h",
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    return str(tmp_path)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.columns == columns
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    clean = set(range(1, 81))
    assert kept[0] == clean | {110, 111, 120, 130}
    assert kept[1] == kept[2] == kept[3] == clean | {120, 130}
    assert [r.text for r in docs.where("doc_id = 120").collect()] == [prose(950)]
    row = docs.where("doc_id = 130").first()
    assert "token" not in row.text and "[assign]" in row.text and row.n_chars == len(row.text)
    assert docs.where("doc_id = 5").count() == 1
    texts = {r.doc_id: [r.text] for r in docs.collect()}
    check(corpus_pipeline.run(spark, folder).collect(), texts, 2048)


def test_empty_table(spark, folder, tmp_path):
    empty = str(tmp_path / "none")
    spark.read.parquet(f"{folder}/documents.parquet").where("false").write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


CORPUS = [n for n in driver.queries() if n not in driver.library_queries()]


def test_queries_are_registered():
    assert {n.split("_")[0] for n in CORPUS} == {*[f"op{i}" for i in range(1, 14)], "pipeline"}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", [n for n in CORPUS if n in driver.oracle_sql()])
def test_query_equals_its_statement(spark, name):
    duck = pytest.importorskip("duckdb").connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    result = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in result.description]
    rows = sorted(map(tuple, driver.queries()[name](spark, SF_DIR).select(*names).collect()))
    assert rows and rows == sorted(result.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", CORPUS)
def test_query(spark, name):
    df = driver.queries()[name](spark, SF_DIR)
    table = TABLES.get(name, "documents")
    if "doc_id" not in df.columns and not table:
        assert df.count() > 0
    elif table:
        assert df.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    else:
        assert df.where(F.col("doc_id").isNotNull()).count() > 0
