"""Documents to training sequences: five stages, each on what the one before has kept.

``run`` writes each stage's rows as Parquet to the shared folder and reads them for the next. All
stages but the last return the columns of their input, whatever they are called. Null and empty
texts go at the first stage; an empty table goes through all stages as one.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import packed, small_batches, stored, table, tokenizer_files
from tierflow.llm.decontaminate import find_contamination
from tierflow.llm.neardup import one_of_each, text_key
from tierflow.llm.packing import pack
from tierflow.llm.rules import quality_rules
from tierflow.llm.secrets import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules(packed(docs, "text", "lang", "source"))
    return judged.where("kept").select("row.*")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    small_batches(spark)
    return one_of_each(packed(docs, "doc_id", "text")).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, found by their texts: ids may repeat or be null."""
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    found = find_contamination(docs.select(text_key(F.col("text")).alias("doc_id"), "text"), items)
    marked = stored(found.select(F.col("doc_id").alias("marked")).distinct())
    rows = packed(docs, "text")
    kept = rows.join(marked, text_key(F.col("text")) == F.col("marked"), "left_anti")
    return kept.select("row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced; ``n_chars`` is that of the new text."""
    clean = redact_secrets(docs)
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", count)
    return clean


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return pack(docs.select("doc_id", "text"), **tokenizer_files())


STAGES = [
    ("quality rules", quality),
    ("near duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("secrets", secrets),
    ("packing", sequences),
]
#: Stages use robust estimates, hashes and a tokenizer, which SQL has no words for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
