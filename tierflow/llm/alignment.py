"""Cross-tokenizer alignment: which ids of two tokenizers cover the same bytes, and how often.

Tokenizer A reads a space and the text, B the text, before which it puts a space itself. Byte offsets
where tokens of both end cut a text into groups; two tokens are linked where their bytes overlap.

An array made beforehand gives for each A id the B id with the same bytes (or -1). Links of such a
pair, nearly all of them groups of one token each, are counted in a vector over A's vocabulary that
each task sums up and emits once. Only the other pairs, of irregular groups, are shuffled: each
chunk of texts (some megabytes) sends a pair once, with the number of its documents, and takes back
the corpus-wide count only where another chunk has the pair too. So a pair that every document has
is a row for each chunk, not for each document. Bounds: what is broadcast has A's vocabulary's
length; a chunk's arrays are bounded by ``CHUNK`` or by its one text, if that is longer.

Defined results: texts that are null or empty, or whose tokens of A or B don't join to the text's
bytes with a space before, have no tokens: zeros and an empty ``groups_sha256``. Repeated rows count
as documents of their own, also under one id or none; of several pairs with an A id's highest count
all are best; an empty table gives no rows; other columns are not looked at; long texts are read
whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import merged, small_batches, stored

#: Bytes of text whose tokens are worked on together.
CHUNK = 4 << 20


class Tokenizers:
    """Both tokenizers, made once for each task, and the bytes of their ids."""

    def __init__(self, ranks: str, pattern: str, model: str):
        import sentencepiece
        import tiktoken

        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        # no special tokens: their strings in a text are plain text
        self._a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=model)
        self.bytes_a = [b""] * (max(table.values()) + 1)
        for piece, i in table.items():
            self.bytes_a[i] = piece
        b = self._b
        self.bytes_b = [
            b"" if b.is_control(i) or b.is_unknown(i)
            else bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
            else b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(b.get_piece_size())
        ]
        self.lengths_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(x) for x in self.bytes_b], np.int64)

    @cached_property
    def identity(self) -> np.ndarray:
        """For each A id the B id with the same bytes, a piece before a single byte, else -1."""
        by_bytes = {x: i for i, x in enumerate(self.bytes_b) if x and self._b.is_byte(i)}
        by_bytes |= {x: i for i, x in enumerate(self.bytes_b) if x and not self._b.is_byte(i)}
        return np.array([by_bytes.get(x, -1) for x in self.bytes_a], np.int64)

    @cached_property
    def digits(self) -> list[bytes]:
        """Numbers as a group lists them: A ids with more behind them, last A ids, B ids likewise."""
        a, b = range(len(self.bytes_a)), range(len(self.bytes_b))
        return [b"%d%s" % (i, mark) for ids, mark in ((a, b","), (a, b"|"), (b, b","), (b, b";")) for i in ids]

    def ids(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and B; none if either tokenizer changes the bytes."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        whole = f" {text}"
        a = np.array(self._a.encode_ordinary(whole), np.int64)
        b = self._b.encode(text, num_threads=1)
        raw = whole.encode()
        if b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return none, none
        # A's ids are cut from these bytes, so only their number could differ
        if self.lengths_a[a].sum() != len(raw):
            return none, none
        return a, np.array(b, np.int64)


def _counted(keys: np.ndarray, docs: int, shift: int):
    """Different (document, value) keys: values, occurrences, and how many each document has."""
    found, n = np.unique(keys, return_counts=True)
    sizes = np.bincount(found >> shift, minlength=docs)
    return found & ((1 << shift) - 1), n, sizes


def align_texts(tools: Tokenizers, texts: list[str | None]) -> dict[str, np.ndarray | list]:
    """Numbers of each text of a chunk, and its links by pair: identical pairs by A id, other pairs."""
    pairs = [tools.ids(t) for t in texts]
    docs = len(texts)
    n_a = np.array([len(a) for a, _ in pairs], np.int64)
    n_b = np.array([len(b) for _, b in pairs], np.int64)
    a = np.concatenate([a for a, _ in pairs] or [np.zeros(0, np.int64)])
    b = np.concatenate([b for _, b in pairs] or [np.zeros(0, np.int64)])
    del pairs
    # between two ends that follow each other lies one token of each side: one link
    ends_a, ends_b = np.cumsum(tools.lengths_a[a]), np.cumsum(tools.lengths_b[b])
    marks = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, np.uint8)
    marks[ends_a] |= 1
    marks[ends_b] |= 2
    marks = marks[marks > 0]
    end_a, end_b = (marks & 1).astype(bool), marks > 1
    both = end_a & end_b
    at_a, at_b, group = (np.cumsum(x) - x for x in (end_a, end_b, both))
    doc = np.repeat(np.arange(docs), n_a)[at_a]
    n_links, n_groups = np.bincount(doc, minlength=docs), np.bincount(doc[both], minlength=docs)

    id_a, id_b = a[at_a], b[at_b]
    same = tools.identity[id_a] == id_b
    shift_a = int(len(tools.bytes_a)).bit_length()
    same_ids, same_n, same_sizes = _counted(doc[same] << shift_a | id_a[same], docs, shift_a)
    other = id_a[~same] * len(tools.bytes_b) + id_b[~same]
    values, place = np.unique(other, return_inverse=True)
    shift = max(1, len(values).bit_length())
    places, pair_n, pair_sizes = _counted(doc[~same] << shift | place, docs, shift)

    # the groups as text: all ids in order of group, then side, then place
    group_a, group_b = group[end_a], group[end_b]
    last_a, last_b = both[end_a], both[end_b]
    size_a, size_b = len(tools.bytes_a), len(tools.bytes_b)
    codes = np.empty(len(a) + len(b), np.int64)
    until_a, until_b = np.cumsum(np.bincount(group_a)), np.cumsum(np.bincount(group_b))
    before_b = np.concatenate([[0], until_b])[group_a]  # B tokens of earlier groups
    codes[np.arange(len(a)) + before_b] = a + last_a * size_a
    codes[np.arange(len(b)) + until_a[group_b]] = b + 2 * size_a + last_b * size_b
    bounds = np.concatenate([[0], np.cumsum(n_a + n_b)])
    digits = tools.digits
    hashes = []
    for i in range(docs):
        listed = b"".join([digits[c] for c in codes[bounds[i] : bounds[i + 1]].tolist()])
        hashes.append(hashlib.sha256(listed[:-1]).hexdigest() if listed else "")
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "hashes": hashes,
        "same_sizes": same_sizes, "same_ids": same_ids, "same_n": same_n,
        "pair_sizes": pair_sizes, "places": places, "pair_n": pair_n,
        "pairs": values, "pair_docs": np.bincount(places, minlength=len(values)),
    }


_INTS = ("n_a", "n_b", "n_groups", "n_links", "same_sizes", "same_ids", "same_n", "pair_sizes", "places", "pair_n")


def aligned_chunks(docs: DataFrame, ranks: str, pattern: str, model: str) -> DataFrame:
    """One row per chunk of texts, and one per task with its counts of identical pairs, stored."""
    kind = docs.schema["doc_id"].dataType
    names = ["chunk", "ids", "hashes", *_INTS, "pairs", "pair_docs", "vector"]

    def align(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = Tokenizers(ranks, pattern, model)
        vector = np.zeros(len(tools.bytes_a), np.int64)
        chunk = TaskContext.get().partitionId() << 32
        for batch in merged(rows, CHUNK):
            found = align_texts(tools, batch.column("text").to_pylist())
            vector += np.bincount(found["same_ids"], minlength=len(vector))
            chunk += 1
            yield row(batch.column("doc_id"), chunk, found)
        place = np.flatnonzero(vector)
        yield row(None, None, {"same_ids": place, "vector": vector[place]})

    def row(ids, chunk, found) -> pa.RecordBatch:
        def cell(values, kind):
            return pa.array([values], pa.list_(kind))

        arrays = [
            pa.array([chunk], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            if ids is not None else pa.nulls(1, pa.list_(id_type)),
            cell(found.get("hashes"), pa.string()),
            *[cell(found.get(c), pa.int32()) for c in _INTS],
            cell(found.get("pairs"), pa.int64()),
            cell(found.get("pair_docs"), pa.int32()),
            cell(found.get("vector"), pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    id_type = to_arrow_type(kind)
    columns = ", ".join(f"{c} array<int>" for c in _INTS)
    return stored(
        docs.select("doc_id", "text").mapInArrow(
            align,
            f"chunk long, ids array<{kind.simpleString()}>, hashes array<string>, {columns}, "
            "pairs array<long>, pair_docs array<int>, vector array<long>",
        ),
        codec="zstd",
        large=True,
    )


def told(pairs: pa.Table) -> pa.Table:
    """One row of a chunk's ``pair`` and ``c``: ``known``, sorted, and ``totals``."""
    pairs = pairs.sort_by("pair").combine_chunks()
    bounds = pa.array([0, len(pairs)], pa.int32())
    lists = [pa.ListArray.from_arrays(bounds, pairs[c].combine_chunks()) for c in ("pair", "c")]
    return pa.table([pairs["chunk"].slice(0, 1), *lists], names=["chunk", "known", "totals"])


def align(docs: DataFrame, ranks: str, pattern: str, model: str) -> DataFrame:
    """Alignment of every row of ``docs`` (``doc_id``, ``text``), links weighed by corpus-wide counts.

    ``ranks`` and ``pattern`` give tokenizer A, ``model`` tokenizer B; the files must be at these
    places on every machine.
    """
    small_batches(docs.sparkSession)
    chunks = aligned_chunks(docs, ranks, pattern, model)
    texts = chunks.where("chunk IS NOT NULL")
    tools = Tokenizers(ranks, pattern, model)
    width = len(tools.bytes_b)
    same = (
        chunks.where("vector IS NOT NULL")
        .select(F.explode(F.arrays_zip("same_ids", "vector")).alias("x"))
        .groupBy(F.col("x.same_ids").alias("a"))
        .agg(F.sum("x.vector").alias("c"))
    )
    own = texts.select("chunk", F.explode(F.arrays_zip("pairs", "pair_docs")).alias("x")).select(
        "chunk", F.col("x.pairs").alias("pair"), F.col("x.pair_docs").cast("long").alias("n")
    )
    counts = stored(own.groupBy("pair").agg(F.sum("n").alias("c")))
    highest = (
        counts.select(F.expr(f"CAST(pair DIV {width} AS int)").alias("a"), "c")
        .unionByName(same)
        .groupBy("a")
        .agg(F.max("c").alias("best"))
        .join(same, "a", "left")
    )
    table = highest.toArrow()  # at most A's vocabulary
    size = len(tools.bytes_a)
    best, identical = np.zeros(size, np.int64), np.zeros(size, np.int64)
    place = table["a"].to_numpy()
    best[place] = table["best"].to_numpy()
    identical[place] = table["c"].fill_null(0).to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast((best, identical, width))

    answers = (
        own.join(counts, "pair")
        .where("c <> n")
        .select("chunk", "pair", "c")
        # sorted rows, which can spill: collect_list would have an object for each pair of 128 chunks
        .groupBy("chunk")
        .applyInArrow(told, "chunk long, known array<long>, totals array<long>")
    )
    wanted = ["ids", "hashes", *_INTS, "pairs", "pair_docs", "known", "totals"]

    def weigh(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, identical, width = shared.value
        for batch in rows:
            for i in range(batch.num_rows):
                cell = {c: batch.column(c)[i] for c in wanted}
                at = {
                    c: v.values.to_numpy().astype(np.int64) if v.is_valid else np.zeros(0, np.int64)
                    for c, v in cell.items() if c not in ("ids", "hashes")
                }
                yield scored(cell["ids"].values, cell["hashes"].values, at, best, identical, width)

    def scored(ids, hashes, at, best, identical, width) -> pa.RecordBatch:
        totals = at["pair_docs"]
        totals[np.searchsorted(at["pairs"], at["known"])] = at["totals"]
        docs = len(ids)
        n_best, total = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
        for sizes, n, c, top in (
            ("same_sizes", "same_n", identical[at["same_ids"]], best[at["same_ids"]]),
            ("pair_sizes", "pair_n", totals[at["places"]], best[at["pairs"] // width][at["places"]]),
        ):
            owner = np.repeat(np.arange(docs), at[sizes])
            np.add.at(total, owner, at[n] * c)
            np.add.at(n_best, owner, at[n] * (c == top))
        plain = [pa.array(at[c]) for c in ("n_a", "n_b", "n_groups", "n_links")]
        return pa.RecordBatch.from_arrays(
            [ids, *plain, pa.array(n_best), pa.array(total), hashes],
            names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        texts.join(stored(answers, large=True), "chunk", "left")
        .select(*wanted)
        .mapInArrow(
            weigh,
            f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
            "count_sum long, groups_sha256 string",
        )
    )
