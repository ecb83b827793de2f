"""What the corpus operators share: folders for intermediate tables, inputs, hashing of words."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of a text are the runs of other characters than these.
SPACES = " \t\n\x0b\x0c\r"
NOT_WORD = r"[\x20\x09-\x0D]+"

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of a batch of whole documents, some 2 MB; at Spark's 10,000 both ends of a task hold ten times that, and copies.
BATCH_ROWS = 1000
#: Bytes of a batch in all, which ends it before that many rows where rows are large.
BATCH_BYTES = 16 << 20
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Row groups of rows of some megabytes each.
_LARGE_ROWS = {
    "parquet.block.size": str(16 << 20),
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder of this application below ``spark.checkpoint.dir``, removed when Python ends.

    Only a local session without that setting gets a temporary folder of its own.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None)
        base = base or spark.sparkContext.getCheckpointDir()
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="tierflow-")
        _roots[app] = root = f"{base.rstrip('/')}/tierflow-{app}"
        atexit.register(_remove, spark, root)
    return _roots[app]


def _remove(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def stored(frame: DataFrame, codec: str = "snappy", large: bool = False) -> DataFrame:
    """The rows of ``frame``, written once to the shared folder and read from there.

    This cuts the lineage: what follows survives lost executors without recomputing the frame.
    Shuffle files of the write are dropped when it is over. ``large`` says that single rows may have
    megabytes: parquet looks at the size of a row group, which a writer and a reader have in memory
    whole, only every 100 rows otherwise.
    """
    spark = frame.sparkSession
    folder = f"{shared_root(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        writer = frame.write.option("compression", codec)
        (writer.options(**_LARGE_ROWS) if large else writer).parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(folder)


def small(frame: DataFrame) -> DataFrame:
    """A stored table in one file: what is joined with it sees how small it is."""
    return stored(frame.repartition(1))


def small_batches(spark: SparkSession) -> None:
    """Whole documents go to Python ``BATCH_ROWS`` at a time, or ``BATCH_BYTES`` if that is less.

    Values that the user has set stay.
    """
    for name, value in ((_BATCH, BATCH_ROWS), (_BYTES, BATCH_BYTES)):
        if name not in spark.conf.getAll:
            spark.conf.set(name, str(value))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_files() -> dict[str, str]:
    """The public tokenizer that sequences are made with."""
    import public_tokenizers

    return {
        "vocabulary": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def second_tokenizer() -> str:
    """The public tokenizer that alignments compare with."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and a struct ``row`` with the whole input row.

    Operators name their own columns beside these, so input columns can have any name.
    """
    return docs.select(*columns, F.struct(*[docs[c] for c in docs.columns]).alias("row"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), NOT_WORD), "")


def shingles_of(words: Column, n: int = 5) -> Column:
    """Hashes of the runs of ``n`` words; a shorter text is one run, a text without words none."""

    def runs(w: Column) -> Column:
        many = F.transform(
            F.sequence(F.lit(0), F.size(w) - n),
            lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(n)]),
        )
        return (
            F.when(F.size(w) >= n, many)
            .when(F.size(w) > 0, F.array(F.xxhash64(w)))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return let(words, runs)


# Vectorised hashing of the words of many texts, for tasks that work on Arrow batches.

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
# A number and its inverse modulo 2**64.
_BASE = np.uint64(0x5851F42D4C957F2D)
_BASE_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_tables: dict[str, np.ndarray] = {}


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    if name not in _tables or len(_tables[name]) < n:
        out = np.full(1 << max(16, (n - 1).bit_length()), base, np.uint64)
        out[0] = 1
        _tables[name] = np.multiply.accumulate(out)
    return _tables[name][:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the bounds of each (one more at the end); nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true places; a bound ends a run."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(inside))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def run_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of pieces of ``raw``: equal pieces have equal hashes wherever they stand.

    Each is the sum of byte codes times powers of a base by place in the piece, modulo 2**64, got
    from running sums over all bytes, and then mixed.
    """
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[raw] * _powers("base", _BASE, len(raw)), out=sums[1:])
    shift = _powers("inverse", _BASE_INVERSE, len(raw) + 1)[starts]
    return mixed((sums[ends] - sums[starts]) * shift)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z as a-z, and for each text its first place among them (one more)."""
    raw, bounds = text_bytes(texts)
    starts, ends = runs(~IS_SPACE[raw], bounds)
    return run_hashes(LOWER[raw], starts, ends), np.searchsorted(starts, bounds).astype(np.int64)


def shingle_hashes(
    hashes: np.ndarray, bounds: np.ndarray, n: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` words of each text, and their bounds by text.

    A text with fewer words is one run; a text without words has none.
    """
    counts = np.diff(bounds)
    many = np.maximum(counts - n + 1, (counts > 0).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(many)])
    owner = np.repeat(np.arange(len(counts)), many)
    at = np.arange(ends[-1]) - ends[owner] + bounds[owner]
    stop = bounds[owner + 1]
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        with_word = at + k < stop
        word = hashes[np.minimum(at + k, len(hashes) - 1)] if len(hashes) else out
        out = np.where(with_word, mixed(out * _ODD + word + np.uint64(k + 1)), out)
    return out, ends


def batches(rows: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of about ``size`` bytes, so that long rows don't meet in memory."""
    for batch in rows:
        step = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def merged(rows: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` bytes, out of smaller and larger ones."""
    held: list[pa.RecordBatch] = []
    for batch in batches(rows, size):
        if held and sum(b.nbytes for b in held) + batch.nbytes > size:
            yield pa.concat_batches(held)
            held = []
        held.append(batch)
    if held:
        yield pa.concat_batches(held)
