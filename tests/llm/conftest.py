import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text), with columns that are called like ones of the operators."""

    def make(rows):
        plain = spark.createDataFrame(rows, "doc_id long, text string")
        return plain.selectExpr(
            "*", "'en' AS lang", "'s' AS source", "7 AS n_words", "'x' AS key", "1.5D AS distance",
            "'r' AS `row`", "true AS kept", "'c' AS class",
        )

    return make


# Texts that every operator must take: null, empty, white space, few words, no ASCII, very long.
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ünïcödé 😀 wörds 日本"), (6, "w " * 30_000),
    (7, "x" * 40_000), (8, "same words in this text"), (8, "same words in this text"),
    (9, "same words in this text"), (None, "no id at all here"),
]
