"""Spelling variants: words one edit apart, grouped under the most frequent spelling.

The vocabulary is counted in tasks that add up before the shuffle. Two words are near if they
differ by one inserted, deleted or replaced code point. If ``L`` is the shorter word's length, such
words share either their first ``L // 2`` code points or their last ``L - L // 2``, so two sorted
lists find all of them: the words, and the words reversed. Each list is sorted by range and cut into
blocks of ``BLOCK`` words. A word visits the blocks whose range holds words with enough of its
beginning (nearly always one), and there only the stretch of such words. The rows of the edit matrix,
three cells wide, are made once for a prefix that adjacent words share; where a row passes one edit,
all words with that prefix are skipped. Some thousand visitors go through a block together.

A block whose own common prefix is more than one edit away isn't visited, so words of one large
family (a long beginning that a third of all words share) visit as many blocks as their edits
reach, not all of the family's. The blocks' bounds, two words for every ``BLOCK``, are broadcast.
Blocks with their visitors are read as sorted streams; a task holds one block.

Defined results: null and empty texts have no runs; a null ``doc_id`` is written as empty text when
a run's crc32 is taken; repeated rows count each; ties between forms go to the smallest word in
code-point order; an empty table gives no rows; other columns are not looked at; long texts are
read whole.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Every run whose crc32 this divides loses a code point.
SLIP = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: Words of a block.
BLOCK = 2048
#: Different words that a task adds up before it passes them on.
HELD = 1 << 18
#: After all words that begin with what it is appended to.
_LAST = "\U0010ffff"


def slipped(prefix_crc: int, run: str) -> str:
    """The run, or the run less one code point; ``prefix_crc`` is that of the document's prefix."""
    h = zlib.crc32(run.encode(), prefix_crc)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def text_words(doc_id: str, text: str | None) -> Counter:
    """Words of one text, after slips, that are long enough."""
    # only A-Z change: other letters' bytes are above them
    runs = Counter(RUN.findall((text or "").encode().lower().decode()))
    prefix = zlib.crc32(f"{doc_id}:".encode())
    out: Counter = Counter()
    for run, n in runs.items():
        if len(run) >= LEAST_LENGTH:
            word = slipped(prefix, run)
            if len(word) >= LEAST_LENGTH:
                out[word] += n
    return out


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word`` and its occurrences ``n``, where there are enough, stored."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches(rows, 1 << 23):
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                held.update(text_words(doc_id, text))
            if len(held) > HELD:
                yield of(held)
                held = Counter()
        yield of(held)

    def of(held: Counter) -> pa.RecordBatch:
        words, numbers = pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())
        return pa.RecordBatch.from_arrays([words, numbers], names=["word", "n"])

    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counted = named.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counted.where(F.col("n") >= LEAST_COUNT))


def _blocks(words: DataFrame) -> DataFrame:
    """Both sorted lists in blocks: ``block``, ``back`` (whether reversed), ``key`` and ``n``, stored."""
    sides = words.selectExpr("false AS back", "word AS key", "n").unionByName(
        words.selectExpr("true AS back", "reverse(word) AS key", "n")
    )
    ordered = sides.repartitionByRange("back", "key").sortWithinPartitions("back", "key")

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        side, room = None, 0
        for batch in rows:
            numbers = []
            for back in batch.column("back").to_pylist():
                if back != side or not room:
                    side, room, block = back, BLOCK, block + 1
                room -= 1
                numbers.append(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), *batch.columns], names=["block", "back", "key", "n"]
            )

    return stored(ordered.mapInArrow(cut, "block long, back boolean, key string, n long"))


def shared_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def next_row(row: tuple[int, int, int], query: str, depth: int, char: str) -> tuple[int, int, int]:
    """The edit matrix's row for a prefix of ``depth`` code points that ends with ``char``.

    Its cells are the edits to the query's first ``depth`` - 1, ``depth`` and ``depth`` + 1 code
    points; more than one edit is 2.
    """
    low, mid, high = row  # at depth - 2, depth - 1 and depth of the query
    n = len(query)
    at = depth - 2  # the last query code point of the first cell
    first = 2 if at >= n else mid + 1 if at < 0 else min(low + (query[at] != char), mid + 1)
    second = min(mid + (query[at + 1] != char), high + 1, first + 1) if at + 1 < n else 2
    third = min(high + (query[at + 2] != char), second + 1) if at + 2 < n else 2
    return min(first, 2), min(second, 2), min(third, 2)


START = (2, 0, 1)


def start_within_an_edit(query: str, prefix: str) -> bool:
    """Whether a word that begins with ``prefix`` can be one edit or none from the query."""
    row = START
    for depth, char in enumerate(prefix, 1):
        row = next_row(row, query, depth, char)
        if min(row) > 1:
            return False
    return True


class SortedWords:
    """A sorted list as what its neighbours share: the rows of the edit matrix belong to prefixes.

    For each depth the list falls into stretches of words with one prefix of that length; the parts of
    a stretch at the next depth follow from the lengths that adjacent words share.
    """

    def __init__(self, words: list[str], shared: list[int]):
        self.words = words
        self._shared = np.array(shared, np.int64)
        self._lengths = np.array([len(w) for w in words], np.int64)
        self._codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self._first = np.cumsum(self._lengths) - self._lengths
        self._depths: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _starts(self, depth: int) -> np.ndarray:
        if depth == 0:
            return np.zeros(min(1, len(self.words)), np.int64)
        return np.flatnonzero((self._shared < depth) & (self._lengths >= depth))

    def stretches(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of the stretches of a depth, and where their parts begin at the next one."""
        if depth not in self._depths:
            starts, parts = self._starts(depth), self._starts(depth + 1)
            self._depths[depth] = starts, np.append(np.searchsorted(parts, starts), len(parts))
        return self._depths[depth]

    def near(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of queries, all of one length, and of the words one edit from them, in pairs.

        Only words that share a query's ``reach`` are looked at. All queries go down the list
        together: each step appends one code point to every prefix that is still within an edit of
        its query, from the row kept for it, and drops the prefixes that no longer are, with all
        words that begin with them.
        """
        n = len(queries[0])
        depth = len(reach(queries[0]))
        codes = np.frombuffer("".join(queries).encode("utf-32-le"), np.uint32).reshape(-1, n)
        starts, _ = self.stretches(depth)
        first = np.array([bisect_left(self.words, reach(q)) for q in queries], np.int64)
        at = np.searchsorted(starts, first)
        here = [
            p < len(starts) and self.words[starts[p]].startswith(reach(q)) for p, q in zip(at, queries)
        ]
        query = np.flatnonzero(here)
        at = at[query]
        # edits between the prefix and the query's first depth - 1, depth and depth + 1 code points
        row = np.tile(np.array([1 if depth else 2, 0, 1 if n > depth else 2], np.int8), (len(query), 1))
        found = []
        while len(query):
            _, parts = self.stretches(depth)
            many = parts[at + 1] - parts[at]
            inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            at = np.repeat(parts[at], many) + inner
            query, row, depth = np.repeat(query, many), np.repeat(row, many, axis=0), depth + 1
            starts = self._starts(depth) if depth not in self._depths else self._depths[depth][0]
            word = starts[at]
            row = next_rows(row, codes[query], depth, self._codes[self._first[word] + depth - 1])
            cell = n - depth + 1
            if 0 <= cell <= 2:
                ends = (self._lengths[word] == depth) & (row[:, cell] == 1)
                found.append((query[ends], word[ends]))
            alive = row.min(axis=1) < 2 if cell >= 0 else np.zeros(len(row), bool)
            query, at, row = query[alive], at[alive], row[alive]
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate([none, *(f[i] for f in found)]) for i in (0, 1))


def next_rows(rows: np.ndarray, queries: np.ndarray, depth: int, chars: np.ndarray) -> np.ndarray:
    """``next_row`` of many prefixes, each with its query's code points."""
    low, mid, high = rows.T
    n = queries.shape[1]

    def differs(place: int) -> np.ndarray:
        return (queries[:, place] != chars).astype(np.int8)

    out = np.full((len(rows), 3), 2, np.int8)
    if 1 <= depth - 1 <= n:
        out[:, 0] = np.minimum(low + differs(depth - 2), mid + 1)
    elif depth == 1:
        out[:, 0] = mid + 1
    if depth <= n:
        out[:, 1] = np.minimum(np.minimum(mid + differs(depth - 1), high + 1), out[:, 0] + 1)
    if depth + 1 <= n:
        out[:, 2] = np.minimum(high + differs(depth), out[:, 1] + 1)
    return np.minimum(out, 2)


def reach(query: str) -> str:
    """The least beginning that a near word of the query shares on one of the lists."""
    return query[: (len(query) - 1) // 2]


def _visits(blocks: DataFrame) -> DataFrame:
    """Every listed word once for each block that it has to be looked for in."""
    bounds = (
        blocks.groupBy("back", "block")
        .agg(F.min("key").alias("first"), F.max("key").alias("last"))
        .toArrow()  # two words for each BLOCK words of a list
        .sort_by([("back", "ascending"), ("first", "ascending")])
        .to_pylist()
    )
    sides = {}
    for back in (False, True):
        own = [b for b in bounds if b["back"] == back]
        columns = [[b[c] for b in own] for c in ("first", "last", "block")]
        common = [b["first"][: shared_start(b["first"], b["last"])] for b in own]
        sides[back] = (*columns, common)
    shared = blocks.sparkSession.sparkContext.broadcast(sides)

    def visit(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = shared.value
        for batch in rows:
            place, numbers = [], []
            columns = (batch.column("back").to_pylist(), batch.column("key").to_pylist())
            for i, (back, key) in enumerate(zip(*columns)):
                firsts, lasts, ids, common = lists[back]
                start = reach(key)
                at = bisect_left(lasts, start)
                while at < len(firsts) and firsts[at] <= start + _LAST:
                    if start_within_an_edit(key, common[at]):
                        place.append(i)
                        numbers.append(ids[at])
                    at += 1
            took = batch.take(pa.array(place, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), *took.columns], names=["block", "back", "key", "n"]
            )

    return blocks.select("back", "key", "n").mapInArrow(
        visit, "block long, back boolean, key string, n long"
    )


class Block:
    """A block's words, and the visitors that wait to be looked for in it."""

    def __init__(self, number: int | None = None, back: bool = False):
        self.number, self.back = number, back
        self.words: list[str] = []
        self.numbers: list[int] = []
        self.shared: list[int] = []
        self.visitors: list[str] = []
        self._sorted: SortedWords | None = None

    def add(self, key: str, n: int) -> None:
        self.shared.append(shared_start(self.words[-1], key) if self.words else 0)
        self.words.append(key)
        self.numbers.append(n)

    def answers(self) -> list[tuple[str, int, int, str]]:
        """For each waiting visitor with near words here: how many, the best one's number, and it."""
        if not self.visitors:
            return []
        self._sorted = self._sorted or SortedWords(self.words, self.shared)
        turn = -1 if self.back else 1
        best: dict[str, tuple[int, int, str]] = {}
        by_length = sorted(self.visitors, key=len)
        self.visitors = []
        for _, group in groupby(by_length, key=len):
            queries = list(group)
            for q, w in zip(*(x.tolist() for x in self._sorted.near(queries))):
                word, other = queries[q][::turn], self.words[w][::turn]
                # each pair counts on one list: on the first if its words share their first half
                if _found_ahead(word, other) != self.back:
                    many, less, form = best.get(word, (0, 0, ""))
                    this = (-self.numbers[w], other)
                    best[word] = (many + 1, *(min(this, (less, form)) if many else this))
        return [(word, many, -less, form) for word, (many, less, form) in best.items()]


def _near(blocks: DataFrame) -> DataFrame:
    """For each word and visited block: ``n_near``, and ``form_n`` and ``form`` of its best near word."""
    visitors = _visits(blocks).withColumn("visitor", F.lit(True))
    both = blocks.withColumn("visitor", F.lit(False)).unionByName(visitors)
    dealt = both.repartition("block").sortWithinPartitions("block", "visitor", "key")

    def search(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in rows:
            columns = (batch.column(c).to_pylist() for c in ("block", "back", "key", "n", "visitor"))
            for number, back, key, n, visitor in zip(*columns):
                if number != block.number:
                    yield of(block.answers())
                    block = Block(number, back)
                if visitor:
                    block.visitors.append(key)
                    if len(block.visitors) >= BLOCK:
                        yield of(block.answers())
                else:
                    block.add(key, n)
        yield of(block.answers())

    def of(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found) if found else ([],) * len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n_near", "form_n", "form"]
        )

    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return dealt.mapInArrow(search, "word string, n_near long, form_n long, form string")


def _found_ahead(word: str, other: str) -> bool:
    """Whether the first list, and not the second, is the one that counts this pair of near words."""
    return shared_start(word, other) >= min(len(word), len(other)) // 2


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """``word`` and ``root`` of the words that have a form: the end of their chains of forms.

    A form is at least twice as frequent as its word, so a chain has at most as many steps as the
    greatest count ``most`` can be halved. Each round follows all steps made so far once more.
    """
    steps = int(math.log2(max(1, most / LEAST_COUNT)))
    roots = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(1, steps)))):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = roots.join(onward, "root", "left")
        roots = stored(further.select("word", F.coalesce("next", "root").alias("root")))
    return roots


def spelling_variants(docs: DataFrame) -> DataFrame:
    """One row per word of ``docs`` (``doc_id``, ``text``): ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    words = vocabulary(docs)
    found = (
        _near(_blocks(words))
        .groupBy("word")
        .agg(
            F.sum("n_near").alias("n_near"),
            F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"),
        )
    )
    enough = F.expr("best.less <= -2 * n")
    forms = stored(
        words.join(found, "word", "left").select(
            "word",
            F.when(enough, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(forms, forms.agg(F.max("n")).first()[0] or 0)
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
