"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its runs of five words: weight is the number of times a run is
found, times an idf. The idf counts every run of every document, in one pass, in a sketch of ``SLOTS``
counters, each the number of documents that have a run of its hash: a run's count is too large by
the runs it shares a counter with, on average by the mean length of a document divided by ``SLOTS``,
as a share of the documents. Counts below the share ``RARE`` aren't told from that, so such runs weigh
alike, 1, and others less the more documents have them, down to ``LEAST_WEIGHT``. Runs of one counter
have one weight in all documents, so similarities are those of one weighting whatever the collisions.
(Weights alone would put the few words in which large groups of copies differ above all that they
share, and lose the group.) Two documents are near duplicates if their similarity passes with these
weights or with all idfs at 1, so no group is lost that plain numbers of times would find, however
large its share of the rows.

Each of ``SAMPLES`` consistent weighted samples agrees between two documents with the probability
of their weighted Jaccard similarity. Samples are banded, those of the plain set and those of the
weighted one, where these differ; documents that share a band are candidates. Exact
copies count as one text from the start. Candidates are verified by both Jaccard similarities
themselves, in blocks of at most ``BLOCK`` texts of one band value: a task compares
all texts of its block and returns links that span its classes, never all pairs. Classes of links
are joined by repeated star contraction. Where a band value has several blocks, members outside the
value's largest class are then compared with all other blocks, so that no candidate pair is
skipped unless both are in one class already.

Defined results: a null text is an empty one; texts without words are in one class only if they
are equal; a text of fewer than five words is one run; rows with one id are rows of their own;
a class is named by its least id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, mixed, shingle_hashes, stored, word_hashes

SIMILARITY = 0.8
SHINGLE = 5
#: Samples of a document, by bands and rows of a band: a pair at the least similarity shares a
#: band with a probability of 0.9998.
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
#: Share of the documents from which ``common_runs`` calls a run common, documents added to the number of
#: all so that runs of a small table weigh nearly alike, and the least weight.
COMMON, PRIOR, LEAST_WEIGHT = 0.25, 1000, 0.05
#: Counters of the sketch, those of one row that is shuffled, and the share up to which counts weigh 1.
SLOTS, SLOT_ROW, RARE = 1 << 22, 1 << 11, 1 / 4096
BLOCK = 256
#: Runs that samples are drawn of together, so that their arrays stay in a core's cache; a longer text goes alone.
PIECE = 1 << 14
#: Documents over which shares of runs are taken first, at least.
LEAST_ROWS = 64

# Inverse distribution functions in 16 bits: of Gamma(2, 1), and its logarithm.
_GRID = (np.arange(65536) + 0.5) / 65536


def _gamma_quantiles() -> np.ndarray:
    x = np.linspace(0, 40, 400_001)
    return np.interp(_GRID, 1 - np.exp(-x) * (1 + x), x)


_GAMMA = _gamma_quantiles().astype(np.float32)
_LOG_GAMMA = np.log(_GAMMA)
_UNIFORM = _GRID.astype(np.float32)
_LOW = np.uint64(0xFFFF)


def weighted_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different runs of each text: hashes, numbers of times, and bounds by text."""
    hashes, ends = shingle_hashes(*word_hashes(texts), SHINGLE)
    owner = np.repeat(np.arange(len(texts)), np.diff(ends))
    # by hash, then by text: numbers of texts that fit 16 bits are sorted by radix
    order = np.argsort(hashes)
    small = owner[order].astype(np.uint16 if len(texts) <= 1 << 16 else np.int64)
    order = order[np.argsort(small, kind="stable")]
    hashes = hashes[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    counts = np.diff(np.concatenate([at, [len(hashes)]]))
    return hashes[at], counts, np.searchsorted(at, ends)


def samples(
    hashes: np.ndarray, weights: np.ndarray, bounds: np.ndarray, number: int = SAMPLES
) -> np.ndarray:
    """Consistent weighted samples, one row for each non-empty set."""
    return samples_of_each(hashes, [weights], bounds, number)[0]


def samples_of_each(
    hashes: np.ndarray, weightings: list[np.ndarray], bounds: np.ndarray, number: int = SAMPLES
) -> list[np.ndarray]:
    """Consistent weighted samples of the same sets with each of several weightings.

    With r and c from Gamma(2, 1) and b uniform, all three drawn from the element's hash and the
    sample's number: t = floor(ln w / r + b), ln y = r (t - b), ln a = ln c - ln y - r. The
    element of the least a, with its t, is the sample.
    """
    full = np.flatnonzero(np.diff(bounds))
    ends = np.concatenate([bounds[:-1][full], bounds[-1:]])
    seeds = mixed(np.arange(1, number + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
    logs = [np.log(w).astype(np.float32) for w in weightings]
    out = [np.empty((len(full), number), np.uint64) for _ in weightings]
    low = 0
    while low < len(full):
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + PIECE, "right")) - 1)
        part = slice(ends[low], ends[high])
        _sample(
            hashes[part], [x[part] for x in logs], ends[low : high + 1] - ends[low], seeds,
            [x[low:high] for x in out],
        )
        low = high
    return [mixed(found) for found in out]


def _sample(
    hashes: np.ndarray, logs: list[np.ndarray], ends: np.ndarray, seeds: np.ndarray, out: list[np.ndarray]
) -> None:
    """Samples of non-empty sets, not yet mixed, into ``out``; arrays are made once for all samples."""
    starts, owner = ends[:-1], np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    others = [np.flatnonzero(x) for x in logs]
    z, bits = np.empty_like(hashes), np.empty_like(hashes)
    at = bits.view(np.int64)
    r, b, one, t, a = (np.empty(len(hashes), np.float32) for _ in range(5))
    is_least = np.empty(len(hashes), bool)
    for k, seed in enumerate(seeds):
        np.bitwise_xor(hashes, seed, out=z)
        z *= np.uint64(0xFF51AFD7ED558CCD)
        np.right_shift(z, np.uint64(32), out=bits)
        z ^= bits
        z *= np.uint64(0xC4CEB9FE1A85EC53)
        for shift, table, drawn in ((0, _GAMMA, r), (16, _UNIFORM, b), (40, _LOG_GAMMA, one)):
            np.right_shift(z, np.uint64(shift), out=bits)
            bits &= _LOW
            np.take(table, at, out=drawn, mode="clip")
        np.subtract(1, b, out=a)
        a *= r
        one -= a  # a where t is 0
        for log_weight, other, found in zip(logs, others, out, strict=True):
            if len(other) * 4 < len(hashes):
                np.copyto(a, one)
                some = r[other]
                a[other] -= some * np.floor(log_weight[other] / some + b[other])
            else:
                np.divide(log_weight, r, out=t)
                t += b
                np.floor(t, out=t)
                t *= r
                np.subtract(one, t, out=a)
            least = np.minimum.reduceat(a, starts)
            np.equal(a, least[owner], out=is_least)
            hit = np.flatnonzero(is_least)
            first = np.ones(len(hit), bool)
            first[1:] = owner[hit[1:]] != owner[hit[:-1]]
            chosen = hit[first]
            steps = np.floor(log_weight[chosen] / r[chosen] + b[chosen]).astype(np.int64)
            found[:, k] = hashes[chosen] + steps.astype(np.uint64) * seeds[0]


def slots_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - (SLOTS - 1).bit_length())).astype(np.int64)


def run_levels(docs: DataFrame) -> np.ndarray:
    """By counter of the sketch: eight times the binary logarithm of the number of documents, rounded.

    Each task counts all its runs; counters travel in rows of ``SLOT_ROW`` and are summed by row, so a
    task holds a sketch at most. One byte of each counter reaches the driver.
    """

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(SLOTS, np.uint32)
        for batch in batches(rows, 1 << 21):
            at, n = np.unique(slots_of(weighted_sets(batch.column("text"))[0]), return_counts=True)
            sums[at] += n.astype(np.uint32)
        sums = sums.reshape(-1, SLOT_ROW)
        for part in np.array_split(np.flatnonzero(sums.any(axis=1)), 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array([sums[i].tobytes() for i in part], pa.binary())],
                names=["row", "counts"],
            )

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in rows:
            for i, counts in zip(batch.column("row").to_pylist(), batch.column("counts"), strict=True):
                own = sums.setdefault(i, np.zeros(SLOT_ROW, np.uint64))
                own += np.frombuffer(counts.as_buffer(), np.uint32)
        levels = [np.rint(8 * np.log2(np.maximum(x, 1))).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], names=["row", "levels"]
        )

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = docs.select("text").mapInArrow(count, "row int, counts binary").repartition(parts, "row")
    out = np.zeros((SLOTS // SLOT_ROW, SLOT_ROW), np.uint8)
    for row in counted.mapInArrow(add, "row int, levels binary").collect():
        out[row.row] = np.frombuffer(row.levels, np.uint8)
    return out.ravel()


def level_weights(total: int) -> np.ndarray:
    """The weight of each level, for ``total`` documents."""
    counts = 2.0 ** (np.arange(256) / 8)
    return np.clip(np.log((total + PRIOR) / counts) / np.log(1 / RARE), LEAST_WEIGHT, 1)


class Weights:
    """The idf of every run: the sketch's levels, broadcast, and the weight of each."""

    def __init__(self, docs: DataFrame, total: int):
        self.levels = docs.sparkSession.sparkContext.broadcast(run_levels(docs))
        self.values = level_weights(total)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return self.values[self.levels.value[slots_of(hashes)]]


def common_runs(docs: DataFrame, total: int) -> dict[int, float]:
    """Weights, by exact counts, of the runs found in at least the share ``COMMON`` of ``total`` documents.

    Kept as the plain definition that the sketch of all runs is checked with.

    Shares are first taken over groups of at least ``LEAST_ROWS`` documents, which pass on at most
    1 / ``COMMON`` times a document's runs; the second pass counts only the runs that are left.
    """

    def groups(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        held, n = [], 0
        for batch in batches(rows, 1 << 21):
            held.append(weighted_sets(batch.column("text"))[0])
            n += batch.num_rows
            if n >= LEAST_ROWS:
                yield n, np.concatenate(held)
                held, n = [], 0
        if n:
            yield n, np.concatenate(held)

    def local(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, hashes in groups(rows):
            runs, counts = np.unique(hashes, return_counts=True)
            # what is beyond the share, in the groups where the share is reached, must make up
            # for all others
            keep = counts >= COMMON * n
            yield pa.RecordBatch.from_arrays(
                [pa.array(runs[keep].view(np.int64)), pa.array(counts[keep] - COMMON * n)],
                names=["h", "beyond"],
            )

    texts = docs.select("text")
    near = (
        texts.mapInArrow(local, "h long, beyond double")
        .groupBy("h")
        .agg(F.sum("beyond").alias("beyond"))
        .where(F.col("beyond") >= COMMON * PRIOR)
        .select("h")
        .toArrow()
    )  # at most the mean number of runs of a document, divided by the share
    if not near.num_rows:
        return {}
    shared = docs.sparkSession.sparkContext.broadcast(np.sort(near["h"].to_numpy().view(np.uint64)))

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        sums = np.zeros(len(wanted), np.int64)
        for batch in batches(rows, 1 << 21):
            hashes, _, _ = weighted_sets(batch.column("text"))
            place = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
            sums += np.bincount(place[wanted[place] == hashes], minlength=len(wanted))
        found = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(wanted[found].view(np.int64)), pa.array(sums[found])], names=["h", "n"]
        )

    exact = (
        texts.mapInArrow(count, "h long, n long")
        .groupBy("h")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= COMMON * (total + PRIOR))
    )
    scale = np.log(1 / COMMON)
    return {
        row.h: max(LEAST_WEIGHT, min(1.0, float(np.log((total + PRIOR) / row.n) / scale)))
        for row in exact.collect()
    }


def _bands(found: np.ndarray) -> np.ndarray:
    """Hashes of the bands of each row of samples."""
    bands = np.zeros((len(found), BANDS), np.uint64)
    for row in range(ROWS):
        bands = mixed(bands * np.uint64(31) + found[:, row::ROWS])
    return mixed(bands + np.arange(1, BANDS + 1, dtype=np.uint64))


def signatures(docs: DataFrame, idf: Weights) -> DataFrame:
    """``doc_id``, ``key`` (of the exact text) and ``bands`` (hashes, none without words)."""

    def sign(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1 << 21):
            hashes, counts, bounds = weighted_sets(batch.column("text"))
            full = np.flatnonzero(np.diff(bounds))
            plain, weighted = map(
                _bands, samples_of_each(hashes, [counts, counts * idf.of(hashes)], bounds)
            )
            both = np.concatenate([plain, weighted], axis=1)
            new = np.concatenate([np.ones(plain.shape, bool), weighted != plain], axis=1)
            values, of = both[new], np.repeat(full, new.sum(axis=1))
            ends = np.cumsum(np.bincount(of, minlength=batch.num_rows))
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), lists],
                names=["doc_id", "key", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(sign, f"doc_id {kind}, key binary, bands array<long>")


def similarities(
    hashes: np.ndarray, counts: np.ndarray, weights: np.ndarray, bounds: np.ndarray
) -> np.ndarray:
    """Weighted Jaccard similarities of all sets of a block, by products of 0/1 matrices.

    A run found n times is n elements, the first to the n-th. Only elements of two sets or more
    meet; they are taken some thousand columns at a time.
    """
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    totals = np.bincount(owner, counts * weights, n)
    spread = np.repeat(np.arange(len(hashes)), counts)
    nth = np.arange(len(spread)) - np.repeat(np.cumsum(counts) - counts, counts)
    element = mixed(hashes[spread] + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ids, column, number = np.unique(element, return_inverse=True, return_counts=True)
    shared = number[column] > 1
    _, column = np.unique(column[shared], return_inverse=True)
    rows, value = owner[spread][shared], np.sqrt(weights[spread][shared])
    order = np.argsort(column, kind="stable")
    rows, column, value = rows[order], column[order], value[order]
    both = np.zeros((n, n))
    width = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        part = slice(*np.searchsorted(column, [low, low + width]))
        matrix = np.zeros((n, width), np.float32)
        matrix[rows[part], column[part] - low] = value[part]
        both += matrix @ matrix.T
    union = totals[:, None] + totals[None, :] - both
    return both / np.maximum(union, 1e-9)


def _spanning(similar: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the classes of ``label`` as all similar pairs do."""
    label = label.copy()
    links = []
    for i, j in zip(*np.nonzero(np.triu(similar, 1)), strict=True):
        if label[i] != label[j]:
            links.append((i, j))
            label[label == label[j]] = label[i]
    return links


def verified(tasks: DataFrame, idf: Weights, similarity: float) -> DataFrame:
    """Links ``a``, ``b`` between the keys of each ``task`` (``key``, ``text``, ``class``).

    Rows of a class are linked already and aren't compared for links of their own.
    """

    def link(keys: list, texts: list, classes: list) -> list[tuple]:
        sets = weighted_sets(pa.array(texts, pa.large_string()))
        weights = idf.of(sets[0])
        plain = np.ones(len(weights))
        alike = similarities(sets[0], sets[1], plain, sets[2]) >= similarity - 1e-6
        if (weights < 1).any():
            alike |= similarities(sets[0], sets[1], weights, sets[2]) >= similarity - 1e-6
        _, label = np.unique(np.array(classes, object).astype(bytes), return_inverse=True)
        return [(keys[i], keys[j]) for i, j in _spanning(alike, label)]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(links: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*links, strict=True)) or [(), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary()) for c in columns], names=["a", "b"]
            )

        task, group = None, ([], [], [])
        for batch in rows:
            found = []
            data = batch.to_pydict()
            for t, *row in zip(data["task"], data["key"], data["text"], data["class"], strict=True):
                if t != task:
                    found += link(*group) if len(group[0]) > 1 else []
                    task, group = t, ([], [], [])
                for column, value in zip(group, row, strict=True):
                    column.append(value)
            yield made(found)
        yield made(link(*group) if len(group[0]) > 1 else [])

    parts = int(tasks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        tasks.select("task", "key", "text", "class")
        .repartition(parts, "task")
        .sortWithinPartitions("task", "key")
        .mapInArrow(run, "a binary, b binary")
    )


def components(links: DataFrame) -> DataFrame:
    """``key``, ``class`` (the least key) of all ends of ``links`` (``a``, ``b``).

    Large star and small star in turn: each node's larger neighbours, then its smaller ones,
    are hung on its least neighbour, until nothing changes and all edges point to the least key.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select("v", "m").where("v <> m")
        down = large.distinct().toDF("u", "v")
        lower = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(lower, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(lower.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        new = stored(small)
        same = new.count() == edges.count() and (
            new.join(edges, ["a", "b"], "left_anti").isEmpty()
        )
        edges = new
        if same:
            break
    return edges.select(F.col("a").alias("key"), F.col("b").alias("class")).union(
        edges.select("b", "b").distinct()
    )


def _named(rows: DataFrame, classes: DataFrame | None) -> DataFrame:
    """``rows`` with the ``class`` of their key, the key itself where it has no link."""
    if classes is None:
        return rows.withColumn("class", F.col("key"))
    return rows.join(classes, "key", "left").withColumn("class", F.coalesce("class", "key"))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def classified(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id`` and ``key`` (of the text) of each row, with the ``class``, named by a key, and

    ``class_id`` (least id of the class) and ``class_rows``. ``docs`` has ``doc_id`` and ``text``.
    """
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    idf = Weights(docs, docs.count())
    signed = stored(signatures(keyed, idf))
    copies = signed.groupBy("key").agg(F.min("doc_id").alias("one"), F.first("bands").alias("bands"))
    entries = copies.select("key", "one", F.explode("bands").alias("bucket"))
    many = entries.groupBy("bucket").agg(F.count("*").alias("n"), F.min("key").alias("leader"))
    entries = stored(entries.join(many.where("n > 1"), "bucket"))

    # the text of one row of each key
    wanted = entries.groupBy("key").agg(F.first("one").alias("one")).withColumnRenamed("key", "k")
    texts = stored(
        keyed.join(wanted, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("one")))
        .groupBy("key")
        .agg(F.first("text").alias("text"))
    )
    # blocks of a band value; its leader is in each, and equal blocks are compared once
    number = F.ceil(F.col("n") / BLOCK)
    block = F.pmod(F.xxhash64("key", "bucket"), number)
    leaders = entries.where(F.col("n") > BLOCK).select(
        "bucket", block.alias("block"), F.col("leader").alias("key")
    )
    blocks = (
        entries.select("bucket", block.alias("block"), "key")
        .unionByName(leaders.distinct())
        .groupBy("bucket", "block")
        .agg(F.array_sort(F.collect_set("key")).alias("keys"))
        .select(F.unhex(F.md5(F.array_join(F.transform("keys", F.hex), ","))).alias("task"), "keys")
        .where("size(keys) > 1")
        .groupBy("task")
        .agg(F.first("keys").alias("keys"))
    )
    tasks = blocks.select("task", F.explode("keys").alias("key")).join(texts, "key")
    links = stored(verified(tasks.withColumn("class", F.col("key")), idf, similarity))
    classes = stored(components(links))

    # members outside the largest class of a band value with several blocks, against all of it
    rest = _named(entries.where(F.col("n") > BLOCK).select("bucket", "key", "n"), classes)
    sizes = rest.groupBy("bucket", "class").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("bucket").agg(
        F.max_by("class", "size").alias("largest"), F.count("*").alias("classes")
    )
    rest = stored(rest.join(largest.where("classes > 1"), "bucket"))
    if not rest.isEmpty():
        outside = rest.where(F.col("class") != F.col("largest"))
        sides = outside.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("sides"))
        of = lambda n: F.pmod(F.xxhash64("key", "bucket"), F.col(n))
        sized = rest.withColumn("blocks", F.ceil(F.col("n") / BLOCK)).join(sides, "bucket")
        first = sized.where(F.col("class") != F.col("largest")).select(
            "bucket", "key", "class", of("sides").alias("i"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("j"),
        )
        second = sized.select(
            "bucket", "key", "class",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)).alias("i"),
            of("blocks").alias("j"),
        )
        task = F.unhex(F.md5(F.concat_ws(":", "bucket", "i", "j")))
        tasks = first.unionByName(second).distinct().select(task.alias("task"), "key", "class")
        more = stored(verified(tasks.join(texts, "key"), idf, similarity))
        if not more.isEmpty():
            classes = stored(components(links.union(more)))

    rows = _named(signed.select("doc_id", "key"), classes)
    named = rows.groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_rows")
    )
    return rows.join(named, "class").select("doc_id", "key", "class", "class_id", "class_rows")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id``, ``class_id`` (the least id of its class) and ``class_rows`` of each row."""
    return classified(docs, similarity).select("doc_id", "class_id", "class_rows")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` for each class: one with the class's least id.

    ``docs`` has ``doc_id``, ``text`` and any other columns.
    """
    found = stored(classified(docs.select("doc_id", "text"), similarity))
    least = found.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    chosen = stored(least.groupBy("class", "class_id").agg(F.min("key").alias("chosen")))
    kept = docs.withColumn("text_key", text_key(F.col("text"))).join(
        chosen,
        (F.col("text_key") == F.col("chosen")) & F.col("doc_id").eqNullSafe(F.col("class_id")),
        "left_semi",
    )
    again = least.groupBy("doc_id", "key").agg(F.count("*").alias("n")).where("n > 1")
    if not again.isEmpty():  # rows with one id and one text
        kept = kept.dropDuplicates(["doc_id", "text_key"])
    return kept.drop("text_key")
