"""One query for each corpus operator, over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from .alignment import align
from .brown import class_scores
from .chat import link_quotations
from .common import second_tokenizer, table, tokenizer_files
from .decontaminate import find_contamination
from .html import extract_text
from .licenses import license_labels, scan_licenses
from .neardup import near_duplicates
from .packing import pack
from .pii import find_personal_data
from .quality import classify
from .rules import quality_rules
from .secrets import scan_secrets
from .spelling import spelling_variants


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, **tokenizer_files())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality_rules(docs).select("doc_id", *counts, "base_failed", "kept", "distance")


def op3_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotations(table(spark, sf_dir, "conversations"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", "quality AS label")
    return classify(docs, labels)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return find_contamination(docs, items)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    first = tokenizer_files()
    return align(docs, first["ranks"], first["pattern"], second_tokenizer())


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_packing": op2_packing,
    "op3_class_scores": op3_class_scores,
    "op4_quotation_links": op4_quotation_links,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_personal_data": op6_personal_data,
    "op7_quality_rules": op7_quality_rules,
    "op8_decontamination": op8_decontamination,
    "op9_html_text": op9_html_text,
    "op10_secret_scan": op10_secret_scan,
    "op11_license_scan": op11_license_scan,
    "op12_token_alignment": op12_token_alignment,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}


def _shingles_sql(table: str, key: str) -> str:
    words = (
        "list_filter(regexp_split_to_array(translate(lower(text), '.,;:!?\"''()[]{}', ''), "
        "'[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    )
    return (
        f"SELECT {key}, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), "
        "lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] "
        f"ELSE [] END AS s FROM (SELECT {key}, {words} AS w FROM {table}) t"
    )


# Other methods than exact containment use estimates, hashes or parsers that SQL has no words for.
ORACLE: dict[str, str] = {
    "op8_decontamination": (
        f"WITH d AS (SELECT doc_id, unnest(s) AS g FROM ({_shingles_sql('documents', 'doc_id')}) a), "
        f"i AS (SELECT item_id, len(s) AS n, unnest(s) AS g "
        f"FROM ({_shingles_sql('benchmark', 'item_id')}) b) "
        "SELECT doc_id, item_id, n AS item_shingles, count(*) AS found, count(*) / n AS containment "
        "FROM d JOIN i USING (g) GROUP BY doc_id, item_id, n HAVING count(*) >= 0.8 * n"
    ),
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
