"""Class-based bigram scores: words in classes found by exchange, smoothed class transitions.

A text's probability is the product, over its tokens, of the probability of the token's class
after the class before it, and of the token in its class. Words seen ``LEAST_COUNT`` times or more
in all training texts are clustered, however many they are and whatever the size of the corpus: the
most frequent ones start in classes of their own, and in each sweep every word is exchanged into the
class that makes its left and right neighbours' classes most probable, by the counts of the sweep
before. Rarer words are in classes by their last two bytes, where unseen words have the share of
those seen once. The end token is a class of its own; it also stands before each text.

The corpus is written once as chunks of token numbers with the chunk's own vocabulary. Words are dealt
to buckets by the first bits of their hash: a chunk sends each bucket one row with what it counts of
the bucket's words (how often they occur; with which classes beside them), the bucket sums up, and
answers each chunk by one row with what holds in the whole corpus (counts; classes). So no vocabulary
is in one place, on the driver or in a broadcast; buckets grow in number with the corpus, not in size.

Defined results: a null or empty text is the end token alone; rows with one id are scored each; a
null id is held out; without training texts all words are unseen; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, LOWER, batches, merged, run_hashes, runs, small_batches, stored, text_bytes

LEAST_COUNT = 5
#: Classes: the end token, those of the exchange, and those of rarer words by their last bytes.
EXCHANGED, RARE = 48, 16
CLASSES = 1 + EXCHANGED + RARE
SWEEPS = 3
#: Weight of the class's own share in its transitions, and of a token in the base model.
PRIOR, BASE_PRIOR = 20.0, 0.1
#: The end token's number; no word has it but by chance of one in 2**64.
END = np.uint64(0x1D8AF066E5F1C3A7)
#: Bytes of text in a chunk.
CHUNK = 8 << 20
#: Words that a bucket has of all chunks together, on average; words of it that are exchanged together.
BUCKET, SPAN = 1 << 20, 4096
#: Cells of a chunk's dense count of neighbours; with more it sorts them.
DENSE = 1 << 24

_CHUNK_SCHEMA = (
    "chunk long, held array<boolean>, sizes array<int>, tokens binary, words binary, "
    "tails binary, counts binary, n_words int"
)
#: A bucket's answer: about a chunk's words at places ``at``, or, without a chunk, about its own words.
_ANSWER_SCHEMA = (
    "chunk long, bucket int, at binary, words binary, tails binary, counts binary, classes binary"
)
_KINDS = {
    "tokens": np.int32, "words": np.uint64, "tails": np.uint8, "counts": np.int64, "at": np.int32,
    "classes": np.uint8, "sizes_of": np.uint8, "places": np.uint8, "ns": np.int32, "pairs": np.int64,
}
#: Cells that are sorted, for the most part.
_RISING = ("words", "at")


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the tokens of each text, the end token last; their last bytes' class; sizes."""
    raw, bounds = text_bytes(texts)
    raw = LOWER[raw]
    starts, ends = runs(~IS_SPACE[raw], bounds)
    hashes = run_hashes(raw, starts, ends) if len(raw) else np.zeros(0, np.uint64)
    last = raw[ends - 1].astype(np.int64) if len(raw) else np.zeros(0, np.int64)
    before = np.where(ends - starts > 1, raw[np.maximum(ends - 2, 0)], 0) if len(raw) else last
    tails = ((last * 31 + before) * 2654435761 >> 7) % RARE
    first = np.searchsorted(starts, bounds)
    at = first[1:]  # an end token goes behind each text's words
    hashes = np.insert(hashes, at, END)
    return hashes, np.insert(tails, at, 0).astype(np.uint8), np.diff(first) + 1


def chunks(docs: DataFrame) -> DataFrame:
    """Chunks of ``docs`` (``doc_id``, ``text``, ``held``): see ``_CHUNK_SCHEMA``; and ``ids``.

    ``tokens`` are numbers in the chunk's ``words``, the frequent ones first; ``counts`` are those of
    its texts that aren't held out. A chunk is a row of some megabytes, and goes through a shuffle for each sweep.
    """

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in merged(rows, CHUNK):
            parts = [tokens_of(part.column("text")) for part in batches([batch], 1 << 21)]
            hashes, tails, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
            words, first, place, n = np.unique(hashes, True, True, True)
            # equally frequent ones by hash, so that both tokens and hashes compress
            order = np.argsort(-n, kind="stable")
            rank = np.empty(len(words), np.int32)
            rank[order] = np.arange(len(words))
            words, first, place = words[order], first[order], rank[place]
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            train = np.repeat(~held, sizes)
            counts = np.bincount(place[train], minlength=len(words))
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            yield pa.RecordBatch.from_arrays(
                [
                    one(batch.column("doc_id")),
                    pa.array([number], pa.int64()),
                    one(pa.array(held)),
                    one(pa.array(sizes.astype(np.int32))),
                    _column("tokens", [place]),
                    _column("words", [words]),
                    _column("tails", [tails[first]]),
                    _column("counts", [counts]),
                    pa.array([len(words)], pa.int32()),
                ],
                names=["ids", "chunk", "held", "sizes", "tokens", "words", "tails", "counts", "n_words"],
            )
            number += 1

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.mapInArrow(encode, f"ids array<{kind}>, {_CHUNK_SCHEMA}"), "zstd", large=True)


def _cell(values: np.ndarray, name: str) -> bytes:
    """An array as a binary cell: first bytes of all numbers, then second ones, compressed; rising ones by steps."""
    values = np.ascontiguousarray(values, _KINDS[name])
    if name in _RISING:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _array(value: pa.BinaryScalar, name: str) -> np.ndarray:
    kind = np.dtype(_KINDS[name])
    raw = value.as_buffer()
    n = int.from_bytes(memoryview(raw)[:8], "little") if raw is not None else 0
    if not n:
        return np.zeros(0, kind)
    planes = pa.decompress(raw.slice(8), n * kind.itemsize, "zstd", asbytes=True)
    values = np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T
    values = np.ascontiguousarray(values).view(kind).reshape(n)
    return np.cumsum(values, dtype=kind) if name in _RISING else values


def _cells(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Rows of a batch, binary cells as arrays; ``answers`` are a table of rows."""
    for i in range(batch.num_rows):
        row = []
        for name in names:
            value = batch.column(name)[i]
            if name in ("held", "sizes"):
                row.append(value.values.to_numpy(zero_copy_only=False))
            elif name in _KINDS:
                row.append(_array(value, name))
            elif name == "answers":
                row.append(pa.RecordBatch.from_struct_array(value.values) if value.is_valid else None)
            else:
                row.append(value)
        yield tuple(row)


def _column(name: str, arrays: list[np.ndarray | None]) -> pa.Array:
    return pa.array([None if x is None else _cell(x, name) for x in arrays], pa.binary())


def _by_hash(words: np.ndarray, *others: np.ndarray, tokens: np.ndarray | None = None) -> list[np.ndarray]:
    """A chunk's words and what belongs to them in the order of the hashes, the tokens as places there."""
    order = np.argsort(words)
    found = [words[order], *[x[order] for x in others]]
    if tokens is None:
        return found
    place = np.empty(len(words), np.int32)
    place[order] = np.arange(len(words))
    return [place[tokens], *found]


def occurrences(corpus: DataFrame) -> DataFrame:
    """``chunk``, ``h`` (word), ``tail`` and ``n`` (training tokens) of each chunk's words."""

    def listed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for chunk, words, tails, counts in _cells(batch, "chunk", "words", "tails", "counts"):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk.as_py()] * len(words), pa.int64()),
                        pa.array(words.view(np.int64)),
                        pa.array(tails.astype(np.int32)),
                        pa.array(counts),
                    ],
                    names=["chunk", "h", "tail", "n"],
                )

    return corpus.select("chunk", "words", "tails", "counts").mapInArrow(
        listed, "chunk long, h long, tail int, n long"
    )


def _bits(corpus: DataFrame) -> int:
    """Bits of a hash that name its bucket."""
    total = corpus.agg(F.sum(F.col("n_words").cast("long"))).first()[0] or 0
    return max(0, int(total // BUCKET).bit_length())


def _slices(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """Bucket and bounds of each bucket that has any of the sorted ``hashes``."""
    if not len(hashes):
        return
    buckets = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    first = np.flatnonzero(np.diff(buckets, prepend=-1))
    for low, high in zip(first, [*first[1:], len(hashes)]):
        yield int(buckets[low]), int(low), int(high)


def totals(corpus: DataFrame, bits: int) -> DataFrame:
    """Corpus-wide training counts: for each chunk, of the words whose count it can't know.

    Rows without a chunk have all words that occur in training texts, with their last bytes' class.
    """

    def send(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for chunk, *cells in _cells(batch, "chunk", "words", "tails", "counts"):
                words, tails, counts = _by_hash(*cells)
                parts = list(_slices(words, bits))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk.as_py()] * len(parts), pa.int64()),
                        pa.array([b for b, _, _ in parts], pa.int32()),
                        pa.array([low for _, low, _ in parts], pa.int32()),
                        _column("words", [words[low:high] for _, low, high in parts]),
                        _column("tails", [tails[low:high] for _, low, high in parts]),
                        _column("counts", [counts[low:high] for _, low, high in parts]),
                    ],
                    names=["chunk", "bucket", "start", "words", "tails", "counts"],
                )

    def add(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        parts = {c: [_array(x, c) for x in block[c]] for c in ("words", "tails", "counts")}
        words, tails, own = (np.concatenate(parts[c]) for c in ("words", "tails", "counts"))
        known, first, index = np.unique(words, return_index=True, return_inverse=True)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, index, own)
        everywhere = total[index]
        bounds = np.cumsum([0, *map(len, parts["words"])])
        at, counts = [], []
        for start, low, high in zip(block["start"].to_numpy(), bounds, bounds[1:]):
            # a chunk knows the count of a word that no other chunk has
            place = np.flatnonzero(everywhere[low:high] != own[low:high])
            at.append((start + place).astype(np.int32))
            counts.append(everywhere[low:high][place])
        seen = total > 0
        bucket = block["bucket"][0].as_py()
        empty = [None] * len(at)
        return pa.table(
            {
                "chunk": pa.array([*block["chunk"].to_pylist(), None], pa.int64()),
                "bucket": pa.array([bucket] * (len(at) + 1), pa.int32()),
                "at": _column("at", [*at, None]),
                "words": _column("words", [*empty, known[seen]]),
                "tails": _column("tails", [*empty, tails[first][seen]]),
                "counts": _column("counts", [*counts, total[seen]]),
                "classes": _column("classes", [*empty, None]),
            }
        )

    sent = corpus.select("chunk", "words", "tails", "counts").mapInArrow(
        send, "chunk long, bucket int, start int, words binary, tails binary, counts binary"
    )
    return stored(sent.groupBy("bucket").applyInArrow(add, _ANSWER_SCHEMA), "zstd", large=True)


@dataclass
class Vocabulary:
    """What the driver knows of the training words: ``n`` tokens, ``v`` different words, no list of them.

    ``first`` has the hashes of the most frequent words, which begin in classes of their own. ``rare``
    has, by class of rarer words, their tokens and how many are seen once. A row of ``moves`` is the
    logarithm of each class's probability after the row's class, ``sizes`` are the classes' tokens.
    ``bits`` name a word's bucket, ``answers`` are those of ``totals``, ``classes`` those of the last
    sweep, if there was one.
    """

    n: int
    v: int
    first: np.ndarray
    rare: np.ndarray
    bits: int | None = None
    answers: DataFrame | None = None
    classes: DataFrame | None = None
    moves: np.ndarray | None = None
    sizes: np.ndarray | None = None
    _found: dict = field(default_factory=dict)

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Classes of exchanged words, -1 for others: a look at single words, a bucket at a time."""
        out = np.full(len(hashes), -1)
        order = np.argsort(hashes)
        for bucket, low, high in _slices(hashes[order], self.bits):
            key = (id(self.classes), bucket)
            if key not in self._found:
                rows = self.classes.where(f"chunk IS NULL AND bucket = {bucket}").toArrow()
                cells = [[_array(x, c) for x in rows[c]] for c in ("words", "classes")]
                self._found[key] = [np.concatenate([np.zeros(0, np.uint64), *x]) for x in cells]
            words, classes = self._found[key]
            if len(words):
                wanted = hashes[order[low:high]]
                place = np.minimum(np.searchsorted(words, wanted), len(words) - 1)
                out[order[low:high]] = np.where(words[place] == wanted, classes[place].astype(np.int64), -1)
        return out

    def classes_of(self, number: np.ndarray, hashes: np.ndarray, tails: np.ndarray) -> np.ndarray:
        return _kinds(number, hashes, tails)


def _kinds(number: np.ndarray, hashes: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """Classes of words: those of exchanged ones are given, others (-1) go by their last bytes."""
    found = np.where(number >= 0, number, 1 + EXCHANGED + tails.astype(np.int64))
    return np.where(hashes == END, 0, found)


def vocabulary(words: DataFrame) -> Vocabulary:
    """From all training ``words`` (``h``, ``tail``, ``c``)."""
    total = words.agg(F.sum("c"), F.count("*")).first()
    n, v = int(total[0] or 0), int(total[1])
    end = F.lit(int(END.astype(np.int64)))
    # the most frequent words have classes of their own, the others begin in the last one; of words
    # equally frequent the one with the smaller hash, as a number without a sign, comes first
    first = (
        words.where((F.col("c") >= LEAST_COUNT) & (F.col("h") != end))
        .orderBy(F.desc("c"), F.col("h") < 0, "h")
        .limit(EXCHANGED - 1)
    )
    rare = np.zeros((2, RARE))
    sums = (
        words.where((F.col("c") < LEAST_COUNT) & (F.col("h") != end))
        .groupBy("tail")
        .agg(F.sum("c"), F.sum((F.col("c") == 1).cast("long")))
    )
    for tail, tokens, once in sums.collect():  # one row for each class
        rare[:, tail] = tokens, once
    hashes = np.array([r.h for r in first.select("h").collect()], np.int64).view(np.uint64)
    return Vocabulary(n, v, hashes, rare)


def answered(corpus: DataFrame, answers: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of each chunk and ``answers``, all answers to it."""
    found = answers.where("chunk IS NOT NULL").groupBy("chunk").agg(
        F.collect_list(F.struct("at", "counts", "classes")).alias("answers")
    )
    return corpus.join(found, "chunk", "left").select(*columns, "answers")


def _told(own: np.ndarray, answers: pa.RecordBatch | None) -> tuple[np.ndarray, np.ndarray]:
    """Corpus-wide counts of a chunk's words, and classes of those that have one, else -1."""
    counts, number = own.copy(), np.full(len(own), -1)
    for at, found, classes in _cells(answers, "at", "counts", "classes") if answers is not None else ():
        if len(classes):
            number[at] = classes
        else:
            counts[at] = found
    return counts, number


def _first_classes(counts: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Classes of the words before any sweep, -1 for rarer ones."""
    number = np.where((counts >= LEAST_COUNT) & (hashes != END), EXCHANGED, -1)
    place = np.searchsorted(hashes, first)
    place[place == len(hashes)] = 0
    there = hashes[place] == first if len(hashes) else np.zeros(len(first), bool)
    number[place[there]] = 1 + np.flatnonzero(there)
    return number


def neighbours(corpus: DataFrame, known: Vocabulary, words: bool) -> DataFrame:
    """Counts over all training texts, by the classes of the last sweep, as the chunks send them.

    A row without a bucket has a task's ``pairs`` of classes, one behind the other. Others, if
    ``words``, have for a bucket and a chunk the exchanged ``words`` at places ``at``, of each the
    number of its ``places`` (a class before it, or, from CLASSES on, behind it), and those with
    their counts ``ns``.
    """
    if known.bits is None:
        known.bits = _bits(corpus)
    if known.answers is None:
        known.answers = totals(corpus, known.bits)
    bits, first = known.bits, known.first if known.classes is None else None

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(CLASSES**2, np.int64)
        names = ("chunk", "held", "sizes", "tokens", "words", "tails", "counts", "answers")
        for batch in rows:
            for chunk, held, sizes, tokens, *cells, answers in _cells(batch, *names):
                tokens, hashes, tails, own = _by_hash(*cells, tokens=tokens)
                counts, number = _told(own, answers)
                if first is not None:
                    number = _first_classes(counts, hashes, first)
                kind = _kinds(number, hashes, tails).astype(np.int32)
                token = tokens[np.repeat(~held.astype(bool), sizes)]
                after = kind[token]
                # texts end with the end token
                before = np.concatenate([np.zeros(min(1, len(after)), np.int32), after[:-1]])
                pairs += np.bincount(before * CLASSES + after, minlength=CLASSES**2)
                if words:
                    at = np.flatnonzero(number >= 0)
                    yield sent(chunk.as_py(), hashes, at, token, before, after)
        cells = [_column(c, [pairs if c == "pairs" else None]) for c in columns[2:]]
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), *cells], names=columns)

    def sent(chunk, hashes, at, token, before, after) -> pa.RecordBatch:
        rank = np.full(len(hashes), -1, np.int64)
        rank[at] = np.arange(len(at))
        word = rank[token]
        left = word >= 0
        right = left[:-1]
        width = 2 * CLASSES
        keys = np.concatenate(
            [word[left] * width + before[left], word[:-1][right] * width + CLASSES + after[1:][right]]
        )
        if len(at) * width <= DENSE:
            n = np.bincount(keys, minlength=len(at) * width)
            found = np.flatnonzero(n)
            n = n[found]
        else:
            found, n = np.unique(keys, return_counts=True)
        word, place = np.divmod(found, width)
        # 2 * CLASSES at most, so a byte each; 0 for words of held-out texts, whose class is asked for too
        each = np.bincount(word, minlength=len(at))
        bounds = np.concatenate([[0], np.cumsum(each)])
        parts = list(_slices(hashes[at], bits))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([chunk] * len(parts), pa.int64()),
                pa.array([b for b, _, _ in parts], pa.int32()),
                _column("at", [at[i:j] for _, i, j in parts]),
                _column("words", [hashes[at[i:j]] for _, i, j in parts]),
                _column("sizes_of", [each[i:j] for _, i, j in parts]),
                _column("places", [place[bounds[i] : bounds[j]] for _, i, j in parts]),
                _column("ns", [n[bounds[i] : bounds[j]] for _, i, j in parts]),
                _column("pairs", [None] * len(parts)),
            ],
            names=columns,
        )

    columns = ["chunk", "bucket", "at", "words", "sizes_of", "places", "ns", "pairs"]
    told = known.answers if known.classes is None else known.classes
    asked = answered(corpus, told, "chunk", "held", "sizes", "tokens", "words", "tails", "counts")
    kinds = ", ".join(f"{c} binary" for c in columns[2:])
    return stored(asked.mapInArrow(count, f"chunk long, bucket int, {kinds}"), "zstd", large=True)


def _pairs(counts: DataFrame) -> np.ndarray:
    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**2, np.int64)
        for batch in rows:
            for (pairs,) in _cells(batch, "pairs"):
                total += pairs
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], names=["place", "n"])

    sums = counts.where("bucket IS NULL").select("pairs").mapInArrow(add, "place long, n long")
    found = sums.groupBy("place").agg(F.sum("n").alias("n")).toArrow()  # at most the square of the classes
    out = np.zeros(CLASSES * CLASSES)
    out[found["place"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(CLASSES, CLASSES)


def transitions(pairs: np.ndarray) -> np.ndarray:
    """Logarithms of class probabilities after each class, smoothed by the classes' own shares."""
    share = (pairs.sum(axis=0) + 1) / (pairs.sum() + CLASSES)
    return np.log10((pairs + PRIOR * share) / (pairs.sum(axis=1, keepdims=True) + PRIOR))


def exchanged(counts: DataFrame, known: Vocabulary, pairs: np.ndarray) -> DataFrame:
    """Classes of the exchanged words after a sweep: each goes where its neighbours fit best.

    A word's tokens in class b add, by each class x before, log N(x, b) / N(b), and by each class
    x behind it, log N(b, x) / N(b), up to what is the same for all b. Rows without a chunk have a
    bucket's words.
    """
    smooth = pairs + 0.5
    size = smooth.sum(axis=1)
    into = np.log(smooth / size[None, :])  # x before, b
    out_of = np.log(smooth / size[:, None])  # b, x behind
    choice = slice(1, 1 + EXCHANGED)
    gains = np.concatenate([into[:, choice], out_of[choice].T])  # 2 * CLASSES by classes
    width = 2 * CLASSES

    def choose(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        names = ("words", "sizes_of", "places", "ns")
        parts = {c: [_array(x, c) for x in block[c]] for c in names}
        hashes, sizes, places, ns = (np.concatenate(parts[c]) for c in names)
        found, index = np.unique(hashes, return_inverse=True)
        word = np.repeat(index.astype(np.int32), sizes)
        order = np.argsort(word, kind="stable")
        word = word[order]
        best = np.zeros(len(found), np.uint8)
        starts = np.arange(0, len(found), SPAN)
        bounds = np.searchsorted(word, [*starts, len(found)])
        for first, low, high in zip(starts, bounds, bounds[1:]):
            rows = min(SPAN, len(found) - first)
            own = order[low:high]
            cells = (word[low:high].astype(np.int64) - first) * width + places[own]
            matrix = np.bincount(cells, ns[own], rows * width).reshape(rows, width)
            best[first : first + rows] = np.argmax(matrix @ gains, axis=1) + 1
        cuts = np.cumsum([len(x) for x in parts["words"]])[:-1]
        rows = block.num_rows
        return pa.table(
            {
                "chunk": pa.array([*block["chunk"].to_pylist(), None], pa.int64()),
                "bucket": pa.array([block["bucket"][0].as_py()] * (rows + 1), pa.int32()),
                "at": pa.chunked_array([*block["at"].chunks, pa.nulls(1, pa.binary())], pa.binary()),
                "words": _column("words", [*[None] * rows, found]),
                "tails": pa.nulls(rows + 1, pa.binary()),
                "counts": pa.nulls(rows + 1, pa.binary()),
                "classes": _column("classes", [*np.split(best[index], cuts), best]),
            }
        )

    sent = counts.where("bucket IS NOT NULL").drop("pairs")
    return stored(sent.groupBy("bucket").applyInArrow(choose, _ANSWER_SCHEMA), "zstd", large=True)


def score(corpus: DataFrame, answers: DataFrame, known: Vocabulary, kind: str) -> DataFrame:
    """One row for each text; ``answers`` has the counts and classes that chunks were told."""
    n, v, sizes_of, (all_tokens, seen_once), moves = known.n, known.v, known.sizes, known.rare, known.moves
    first = known.first if known.classes is None else None

    def scored(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            names = ("ids", "held", "sizes", "tokens", "words", "tails", "counts", "answers")
            for ids, held, sizes, tokens, *cells, told in _cells(batch, *names):
                tokens, words, tails, own = _by_hash(*cells, tokens=tokens)
                counts, number = _told(own, told)
                if first is not None:
                    number = _first_classes(counts, words, first)
                classes = _kinds(number, words, tails)
                base = np.log10((counts + BASE_PRIOR) / (n + BASE_PRIOR * (v + 1)))
                # of a word in its class: its share of the class; of rarer words, but for the
                # share of those seen once, which is that of all unseen words
                all_rare, once = all_tokens[tails], seen_once[tails]
                unseen = (once + 0.5) / (all_rare + 1)
                rare = np.where(
                    counts > 0, counts / np.maximum(all_rare, 1) * (1 - unseen), unseen
                )
                often = counts / np.maximum(sizes_of[classes], 1)
                inside = np.where(number >= 0, often, rare)
                inside = np.log10(np.where(words == END, 1.0, np.maximum(inside, 1e-300)))
                after = classes[tokens]
                before = np.concatenate([[0], after[:-1]])
                value = moves[before, after] + inside[tokens]
                starts = np.cumsum(sizes) - sizes
                total = lambda x, starts=starts: np.add.reduceat(x, starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values,
                        pa.array(held.astype(bool)),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(total((counts > 0)[tokens].astype(np.int64))),
                        pa.array(np.full(len(sizes), n, np.int64)),
                        pa.array(total(base[tokens])),
                        pa.array(total(value)),
                    ],
                    names=[
                        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                        "base_score", "score",
                    ],
                )

    asked = answered(corpus, answers, "ids", "held", "sizes", "tokens", "words", "tails", "counts")
    return asked.mapInArrow(
        scored,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


def class_scores(docs: DataFrame, folds: int = 10, sweeps: int = SWEEPS) -> DataFrame:
    """Scores of every row of ``docs`` (``doc_id``, ``text``) in base-10 logarithms.

    Texts whose id's crc32 is divisible by ``folds`` are held out of all counts. ``perplexity`` is
    by token.
    """
    small_batches(docs.sparkSession)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(True))
    kind = docs.schema["doc_id"].dataType.simpleString()
    corpus = chunks(docs.select("doc_id", "text", held.alias("held")))
    bits = _bits(corpus)
    answers = totals(corpus, bits)
    known = vocabulary(occurrences(answers.where("chunk IS NULL")).select("h", "tail", F.col("n").alias("c")))
    known.bits, known.answers = bits, answers
    for _ in range(sweeps):
        counts = neighbours(corpus, known, words=True)
        known.classes = exchanged(counts, known, _pairs(counts))
    pairs = _pairs(neighbours(corpus, known, words=False))
    known.moves, known.sizes = transitions(pairs), pairs.sum(axis=0)
    if known.classes is not None:
        answers = answers.union(known.classes)
    scores = score(corpus, answers, known, kind)
    return scores.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
