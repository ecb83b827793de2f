"""Packing along a space-filling curve.

Documents become token ids, the ids a hashed count vector, the vector a point in a few dimensions
by a random projection, and the point a key on a Hilbert curve. Rows are range-partitioned and
sorted by that key, and each partition cuts the stream of its tokens into sequences. What is left
at the end of a partition is cut into sequences whose lengths are powers of two, which need no
padding. One partition is read as a stream: a task holds one Arrow batch, not its partition.

Defined results: a null or empty text is the end token alone; rows with one key are ordered by
document id and place in the text, and repeated rows are packed each, in any order among
themselves; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import batches, run_hashes, runs, stored, text_bytes

LENGTH = 2048
END = 1
#: Tokens of a row that is sorted: long documents are several rows, so that partitions of equally
#: many rows are about equally large.
PART = 4096
#: Width of the hashed vectors, dimensions they are projected to, bits for each of them.
WIDTH, DIMENSIONS, BITS = 256, 3, 16
#: Entries of a task's table of pieces that are encoded already; a full table starts anew.
MEMORY = 2_000_000
_SPECIAL = "<|endoftext|>"


def _odd_pairs() -> np.ndarray:
    """Pairs of bytes (first * 256 + second) that show white space other than single separators."""
    odd = np.zeros((256, 256), bool)
    odd[np.ix_([10, 32], [10, 32])] = True
    for byte in (0, 9, 11, 12, 13, 28, 29, 30, 31):
        odd[byte, :] = odd[:, byte] = True
    # first two bytes of the white space beyond ASCII, and of some other characters
    for first, second in ((0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80)):
        odd[first, second] = True
    return odd.ravel()


class Encoder:
    """Token ids of texts, as the byte-level BPE of ``tokenizers`` gives them.

    Texts are cut at their spaces and line breaks where each stands alone between other
    characters. There no token of the vocabulary's pattern goes on: a space belongs to what
    follows, a break is a token of its own. So each different piece (a word with or without the
    space before it) is encoded once, and the ids of a text are put together from those of its
    pieces. Texts with other white space are encoded whole, and so are those that spell the
    special token.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self._plain = tiktoken.Encoding(
            "byte_bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )
        self._whole = Tokenizer.from_file(vocabulary)
        self._break = self._plain.encode_ordinary("\n")[0]
        self._odd = _odd_pairs()
        self._forget()

    def _forget(self) -> None:
        self._hashes = np.zeros(0, np.uint64)  # of the known pieces, sorted
        self._starts, self._lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint16)

    def _whole_ids(self, text: str) -> np.ndarray:
        if _SPECIAL in text:
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint16)
        return np.array(self._plain.encode_ordinary(text), np.uint16)

    def _learn(self, hashes, raw, starts, ends) -> None:
        """Encode new pieces in one call, a line break after each."""
        lengths = ends - starts + 1
        at = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        at += np.arange(len(at))
        joined = raw[np.minimum(at, len(raw) - 1)]
        joined[np.cumsum(lengths) - 1] = 10
        ids = np.array(self._plain.encode_ordinary(joined.tobytes().decode()), np.uint16)
        breaks = np.flatnonzero(ids == self._break)
        first = np.concatenate([[0], breaks[:-1] + 1])
        places = np.searchsorted(self._hashes, hashes)
        self._hashes = np.insert(self._hashes, places, hashes)
        self._starts = np.insert(self._starts, places, first + len(self._ids))
        self._lengths = np.insert(self._lengths, places, breaks - first)
        self._ids = np.concatenate([self._ids, ids])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end token, and the bounds of each text's."""
        raw, bounds = text_bytes(texts)
        if not len(raw):
            return np.full(len(texts), END, np.uint16), np.arange(len(texts) + 1)
        odd = np.zeros(len(texts), bool)
        pairs = raw[:-1].astype(np.uint16) << np.uint16(8) | raw[1:]
        odd[np.searchsorted(bounds, np.flatnonzero(self._odd[pairs]), "right") - 1] = True
        separator = (raw == 32) | (raw == 10)
        full = np.flatnonzero(np.diff(bounds))
        odd[full] |= separator[bounds[full]] | separator[bounds[full + 1] - 1]
        special = pc.match_substring(texts.fill_null(""), _SPECIAL)
        odd |= special.to_numpy(zero_copy_only=False)

        starts, ends = runs(~separator, bounds)
        owner = np.searchsorted(bounds, starts, "right") - 1
        regular = ~odd[owner]
        starts, ends, owner = starts[regular], ends[regular], owner[regular]
        opens = starts == bounds[owner]
        spaced = ~opens & (raw[starts - 1] == 32)
        breaks = (~opens & ~spaced).astype(np.int64)  # a break stands before the piece
        starts = starts - spaced
        ids, lengths = self._pieces(raw, starts, ends)

        wholes = {i: self._whole_ids(texts[i].as_py()) for i in np.flatnonzero(odd).tolist()}
        counts = np.bincount(owner, lengths + breaks, len(texts)).astype(np.int64) + 1
        for i, x in wholes.items():
            counts[i] = len(x) + 1
        out_bounds = np.concatenate([[0], np.cumsum(counts)])
        out = np.full(out_bounds[-1], self._break, np.uint16)
        out[out_bounds[1:] - 1] = END
        for i, x in wholes.items():
            out[out_bounds[i] : out_bounds[i + 1] - 1] = x
        if len(starts):
            steps = lengths + breaks
            before = np.cumsum(steps) - steps
            text_first = np.searchsorted(owner, owner, "left")
            place = out_bounds[owner] + before - before[text_first] + breaks
            to = np.repeat(place - (np.cumsum(lengths) - lengths), lengths)
            to += np.arange(len(to))
            out[to] = ids
        return out, out_bounds

    def _pieces(self, raw, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after the other, and the number of each piece's."""
        if not len(starts):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        unique, first, inverse = np.unique(
            run_hashes(raw, starts, ends), return_index=True, return_inverse=True
        )
        if len(self._hashes) > MEMORY:
            self._forget()
        place = np.searchsorted(self._hashes, unique)
        seen = np.zeros(len(unique), bool)
        if len(self._hashes):
            seen = self._hashes[np.minimum(place, len(self._hashes) - 1)] == unique
        if not seen.all():
            new = first[~seen]
            self._learn(unique[~seen], raw, starts[new], ends[new])
            place = np.searchsorted(self._hashes, unique)
        at, lengths = self._starts[place][inverse], self._lengths[place][inverse]
        source = np.repeat(at - (np.cumsum(lengths) - lengths), lengths)
        source += np.arange(len(source))
        return self._ids[source], lengths


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with integer coordinates below ``2**bits``.

    Gray-code descent from the highest bit: at each level the axes are reflected or exchanged
    with the first one, as the sub-cube demands; the coordinates then hold the key's bits.
    """
    x = points.astype(np.uint64).T.copy()
    n, one = len(x), np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        low = bit - one
        for axis in range(n):
            high = (x[axis] & bit) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        flip = np.where((x[n - 1] & bit) != 0, flip ^ (bit - one), flip)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            key = (key << one) | ((x[axis] >> np.uint64(level)) & one)
    return key.astype(np.int64)


def projection(width: int = WIDTH, dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((width, dimensions))


def curve_key(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Hilbert keys of count vectors: logarithms, unit length, projection, grid over four sigma."""
    x = np.log1p(vectors)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    grid = (x @ directions + 4) / 8 * (1 << BITS)
    return hilbert_keys(np.clip(grid, 0, (1 << BITS) - 1).astype(np.int64), BITS)


def tokenised(docs: DataFrame, vocabulary: str, ranks: str, pattern: str) -> DataFrame:
    """Parts of each text: ``doc_id``, ``key``, ``start``, ``ids`` (little-endian unsigned 16-bit)

    and the text's ``total``.
    """

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, directions = Encoder(vocabulary, ranks, pattern), projection()
        for batch in batches(rows, 1 << 21):
            ids, bounds = encoder.encode(batch.column("text"))
            # the end token says nothing of the text: it is counted, for all texts alike
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            bucket = ids.astype(np.int64) * 40503 % 65536 % WIDTH
            counts = np.bincount(owner * WIDTH + bucket, minlength=batch.num_rows * WIDTH)
            keys = curve_key(counts.reshape(-1, WIDTH).astype(float), directions)
            totals = np.diff(bounds)
            parts = -(-totals // PART)
            text = np.repeat(np.arange(batch.num_rows), parts)
            starts = (np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)) * PART
            ends = np.append(bounds[text] + starts, bounds[-1])
            offsets = pa.py_buffer((ends * 2).astype(np.int32))
            data = pa.py_buffer(ids.astype("<u2"))
            column = pa.Array.from_buffers(pa.binary(), len(text), [None, offsets, data])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(text)),
                    pa.array(keys[text]),
                    pa.array(starts),
                    column,
                    pa.array(totals[text]),
                ],
                names=["doc_id", "key", "start", "ids", "total"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, key long, start long, ids binary, total long"
    )


def _powers(n: int) -> list[int]:
    """The powers of two that ``n`` is the sum of, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class _Stream:
    """Pieces of the documents of one partition, in its order."""

    def __init__(self, partition: int, length: int):
        self.length, self.offset = length, 0
        self.sequence = partition << 32
        self.open: list[tuple] = []  # pieces of the last, unfinished sequence

    def add(self, doc_id, start: int, ids: np.ndarray, total: int) -> Iterator[tuple]:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, self.length - self.offset)
            self.open.append((doc_id, start + at, ids[at : at + n], total, self.offset))
            at, self.offset = at + n, self.offset + n
            if self.offset == self.length:
                yield from self._close()

    def _close(self) -> Iterator[tuple]:
        for doc_id, start, ids, total, offset in self.open:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            yield doc_id, start, len(ids), crc, total, self.sequence, offset
        self.open, self.offset = [], 0
        self.sequence += 1

    def rest(self) -> Iterator[tuple]:
        """The tokens left, in sequences whose lengths are powers of two."""
        left, pieces = _powers(self.offset), self.open
        self.open, self.offset = [], 0
        for doc_id, start, ids, total, _ in pieces:
            while len(ids):
                n = min(len(ids), left[0] - self.offset)
                self.open.append((doc_id, start, ids[:n], total, self.offset))
                ids, start, self.offset = ids[n:], start + n, self.offset + n
                if self.offset == left[0]:
                    left.pop(0)
                    yield from self._close()


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = ["doc_id", *[x.split()[0] for x in PIECES.split(", ")]]


def pack(
    docs: DataFrame,
    vocabulary: str,
    ranks: str,
    pattern: str,
    length: int = LENGTH,
) -> DataFrame:
    """Pieces of all documents (``doc_id``, ``text``); see the module.

    ``vocabulary`` is the path of the tokenizer's file, ``ranks`` of the same vocabulary as ranks,
    ``pattern`` its pattern. Sequence ids are unique, not consecutive.
    """
    tokens = stored(tokenised(docs, vocabulary, ranks, pattern), "zstd")

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(TaskContext.get().partitionId(), length)

        def made(pieces: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*pieces, strict=True)) or [()] * len(_NAMES)
            arrays = [pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:]]]
            return pa.RecordBatch.from_arrays(arrays, names=_NAMES)

        kind = None
        for batch in rows:
            kind = batch.column("doc_id").type
            found: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "start", "ids", "total")]
            for doc_id, start, ids, total in zip(*columns, strict=True):
                found += stream.add(doc_id, start, np.frombuffer(ids, "<u2"), total)
            if found:
                yield made(found, kind)
        if kind is not None:
            yield made(list(stream.rest()), kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (
        tokens.repartitionByRange(parts, "key", "doc_id", "start")
        .sortWithinPartitions("key", "doc_id", "start")
        .select("doc_id", "start", "ids", "total")
        .mapInArrow(cut, f"doc_id {kind}, {PIECES}")
    )
