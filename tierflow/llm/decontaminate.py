"""Benchmark decontamination: MinHash containment search with items partitioned by size.

Words are lower case without punctuation, shingles are runs of five words. Items are partitioned
by the power of two below their number of shingles; within a partition an item's MinHash sketch is
its ``SKETCH`` smallest shingle hashes, all of them if it has fewer. As a document that contains an
item contains the item's sketch, whatever the document's length, the shingles of the documents are
probed against the sketches. A document looks only at the partitions whose items are not too large
for it, and looks up only hashes up to the largest of their sketches (a small part of its own if
those items are long). Pairs with enough hits are candidates, and for those the containment of the
item's shingles in the document is computed exactly, from the words themselves.

Defined results: a null or empty text, of a document or an item, has no shingles and no match; a
text of fewer than five words is one shingle, so it matches only a document of the same few words;
rows with one document id (or item id) count as one, which takes its best match; null ids are ids;
an empty table gives no rows. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, shingles_of, stored, words_of

SIMILARITY = 0.8
SKETCH = 16
SHINGLE = 5
PUNCTUATION = ".,;:!?\"'()[]{}"


def _words(text: Column) -> Column:
    return words_of(F.translate(F.lower(text), PUNCTUATION, ""))


def _shingle_texts(text: Column) -> Column:
    """The different shingles as texts."""

    def made(w: Column) -> Column:
        many = F.transform(
            F.sequence(F.lit(1), F.size(w) - SHINGLE + 1),
            lambda i: F.array_join(F.slice(w, i, SHINGLE), " "),
        )
        return (
            F.when(F.size(w) >= SHINGLE, many)
            .when(F.size(w) > 0, F.array(F.array_join(w, " ")))
            .otherwise(F.array().cast("array<string>"))
        )

    return F.array_distinct(let(_words(text), made))


def sketches(items: DataFrame, sketch: int = SKETCH) -> DataFrame:
    """``item_id``, ``h`` of each sketch's hashes, with the size partition and least hits."""
    hashes = F.array_sort(F.array_distinct(shingles_of(_words(F.col("text")), SHINGLE)))
    sized = items.select("item_id", hashes.alias("hashes")).where("size(hashes) > 0")
    return sized.select(
        "item_id",
        F.floor(F.log2(F.size("hashes"))).cast("int").alias("size_class"),
        F.ceil(
            F.when(F.size("hashes") <= sketch, F.size("hashes") * F.lit(SIMILARITY)).otherwise(
                sketch * SIMILARITY / 3
            )
        ).alias("least"),
        F.explode(F.slice("hashes", 1, sketch)).alias("h"),
    )


def _large_enough(size_class: Column, similarity: float) -> Column:
    """Whether a document of ``size`` shingles can contain an item of the partition."""
    return F.col("size") >= similarity * F.pow(F.lit(2.0), size_class)


def find_contamination(
    docs: DataFrame, items: DataFrame, sketch: int = SKETCH, similarity: float = SIMILARITY
) -> DataFrame:
    """Pairs ``doc_id``, ``item_id`` with ``item_shingles``, ``found`` and ``containment``.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``. The least hits of
    a candidate are a third of what is expected at the least containment, which misses one pair
    in a million; items with a whole sketch need all the hits that the containment asks for.
    """
    index = stored(sketches(items, sketch).distinct())
    # by partition (at most one for each power of two): the largest hash of its sketches
    reach = index.groupBy("size_class").agg(F.max("h").alias("h")).orderBy("size_class").collect()
    limit = F.lit(None).cast("long")
    for i, row in enumerate(reach):
        most = max(r.h for r in reach[: i + 1])
        limit = F.when(_large_enough(F.lit(row.size_class), similarity), F.lit(most)).otherwise(limit)
    shingles = F.array_distinct(shingles_of(_words(F.col("text")), SHINGLE))
    sized = docs.select("doc_id", shingles.alias("hashes")).withColumn("size", F.size("hashes"))
    near = F.filter("hashes", lambda x: x <= F.col("limit"))
    probes = sized.withColumn("limit", limit).select("doc_id", "size", F.explode(near).alias("h"))
    candidates = stored(
        probes.join(index, "h")
        .where(_large_enough(F.col("size_class"), similarity))
        .groupBy("doc_id", "item_id", "least")
        .agg(F.size(F.collect_set("h")).alias("hits"))  # at most the sketch's hashes
        .where("hits >= least")
        .select("doc_id", "item_id")
        .distinct()
    )
    chosen = candidates.select("doc_id").distinct()
    texts = docs.join(
        chosen.withColumnRenamed("doc_id", "chosen"),
        F.col("doc_id").eqNullSafe(F.col("chosen")),
        "left_semi",
    ).select("doc_id", _shingle_texts(F.col("text")).alias("have"))
    wanted = items.select("item_id", _shingle_texts(F.col("text")).alias("want"))
    pairs = candidates.select(F.col("doc_id").alias("d"), F.col("item_id").alias("i"))
    return (
        texts.join(pairs, F.col("doc_id").eqNullSafe(F.col("d")))
        .join(wanted, F.col("item_id").eqNullSafe(F.col("i")))
        .select(
            "doc_id",
            "item_id",
            F.size("want").cast("long").alias("item_shingles"),
            F.size(F.array_intersect("want", "have")).cast("long").alias("found"),
        )
        .where((F.col("item_shingles") > 0) & (F.col("found") >= similarity * F.col("item_shingles")))
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("found", "item_shingles")).alias("best"))
        .select(
            "doc_id",
            "item_id",
            "best.item_shingles",
            "best.found",
            (F.col("best.found") / F.col("best.item_shingles")).alias("containment"),
        )
    )
