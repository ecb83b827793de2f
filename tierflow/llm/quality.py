"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of its n-grams, hashed: byte trigrams, words, pairs of words, and
shares of the pairs that repeat. Each indicator is scaled by its class log-count ratio, and a linear
model with squared hinge loss is fitted to the scaled indicators by dual coordinate descent. The
margins of held-back rows are turned into probabilities by a logistic fit.

The ratios are counted over all labelled training rows. Only the linear model is fitted to a bounded
sample: at most ``SAMPLE`` labelled rows, those with the least hashes of their ids. Every row is
scored over its whole text.

Defined results: a null or empty text has no features and gets the score of the bias alone;
without labels of both classes every score is the share of label 1, or 0.5 without labels; rows
with one id are scored each; an empty table gives no rows; a null id counts as held out.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, batches, mixed, run_hashes, runs, stored, text_bytes

#: Hash buckets of the features, rows of the fit, smoothing of the counts, cost of an error, and
#: passes over the sample.
WIDTH, SAMPLE, ALPHA, COST, PASSES = 1 << 18, 8000, 1.0, 1.0, 12
THRESHOLD = 0.3


def _buckets(hashes: np.ndarray, kind: int) -> np.ndarray:
    salt = np.uint64(kind * 0x9E3779B97F4A7C15 % (1 << 64))
    return (mixed(hashes + salt) & np.uint64(WIDTH - 1)).astype(np.int32)


#: Buckets of the shares of repeated pairs and of one word twice, by twentieths reached.
_AGAIN = [_buckets(np.arange(1, 21, dtype=np.uint64), kind) for kind in (4, 5)]


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the different n-grams of each text, and their bounds by text."""
    raw, bounds = text_bytes(texts)
    starts, ends = runs(~IS_SPACE[raw], bounds)
    words = run_hashes(raw, starts, ends) if len(raw) else np.zeros(0, np.uint64)
    pairs = words[:-1] * np.uint64(31) + words[1:]
    twins = words[:-1] == words[1:]
    word_codes, pair_codes = _buckets(words, 2), _buckets(pairs, 3)
    # a trigram's 24 bits, multiplied; the top bits are the bucket
    wide = raw.astype(np.uint32)
    three = wide[:-2] << np.uint32(16) | wide[1:-1] << np.uint32(8) | wide[2:]
    shift = np.uint32(32 - (WIDTH - 1).bit_length())
    tri_codes = (three * np.uint32(2654435761) >> shift).astype(np.int32)
    word_bounds = np.searchsorted(starts, bounds).tolist()

    last = np.zeros(WIDTH, np.int32)  # the last place of each bucket in the text at hand
    out, sizes = [], [0]
    for i, (low, high) in enumerate(itertools.pairwise(bounds.tolist())):
        first, end = word_bounds[i], word_bounds[i + 1]
        parts = [tri_codes[low : max(high - 2, low)], word_codes[first:end]]
        if (n := end - first - 1) > 0:
            # pairs that are found again, or are one word twice, whatever the words: one
            # indicator for each twentieth that their share reaches
            again = n - len(np.unique(pairs[first : end - 1]))
            twice = int(np.count_nonzero(twins[first : end - 1]))
            parts += [pair_codes[first : end - 1], _AGAIN[0][: again * 20 // n], _AGAIN[1][: twice * 20 // n]]
        codes = np.concatenate(parts)
        places = np.arange(len(codes), dtype=np.int32)
        last[codes] = places
        codes = codes[last[codes] == places]  # each bucket once
        out.append(codes)
        sizes.append(len(codes))
    return np.concatenate(out) if out else np.zeros(0, np.int32), np.cumsum(sizes)


@dataclass
class Model:
    """Weights of the buckets and bias; the logistic fit's slope and middle."""

    weights: np.ndarray
    bias: float
    slope: float
    middle: float

    def scores(self, buckets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.weights[buckets])])
        norm = np.sqrt(np.maximum(np.diff(bounds), 1))
        margin = (sums[bounds[1:]] - sums[bounds[:-1]]) / norm + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * (margin - self.middle), -30, 30)))


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Class log-count ratios from counts of documents by class (rows 0 and 1) and bucket."""
    smooth = counts + ALPHA
    smooth = smooth / smooth.sum(axis=1, keepdims=True)
    return np.log(smooth[1] / smooth[0])


def dual_coordinate_descent(
    rows: list[np.ndarray], signs: np.ndarray, ratios: np.ndarray, passes: int = PASSES
) -> tuple[np.ndarray, float]:
    """Weights and bias of the squared-hinge support vector machine (one more constant feature).

    Each step solves one row's dual variable exactly and updates the weights. Rows have unit
    length before scaling by the ratios; errors of the rarer class cost as much in all.
    """
    weights, bias = np.zeros(len(ratios)), 0.0
    values = [ratios[x] / np.sqrt(max(len(x), 1)) for x in rows]
    share = np.array([(signs < 0).mean(), (signs > 0).mean()])
    cost = COST / np.maximum(2 * np.where(signs > 0, share[1], share[0]), 1e-3)
    square = np.array([v @ v + 1 for v in values]) + 0.5 / cost
    alpha = np.zeros(len(rows))
    random = np.random.default_rng(3)
    for _ in range(passes):
        for i in random.permutation(len(rows)):
            x, v, y = rows[i], values[i], signs[i]
            gradient = y * (weights[x] @ v + bias) - 1 + alpha[i] * 0.5 / cost[i]
            new = max(alpha[i] - gradient / square[i], 0.0)
            step = (new - alpha[i]) * y
            if step:
                weights[x] += step * v  # a row's buckets are all different
                bias += step
                alpha[i] = new
    return weights, bias


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and middle of a logistic curve through margins, by Newton steps on smoothed labels."""
    ones, zeros = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    design = np.stack([margins, np.ones(len(margins))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        weight = np.maximum(p * (1 - p), 1e-6)
        hessian = design.T @ (design * weight[:, None]) + 1e-3 * np.eye(2)
        beta = beta - np.linalg.solve(hessian, design.T @ (p - target) + 1e-3 * (beta - [1.0, 0.0]))
    slope = max(float(beta[0]), 1e-3)
    return slope, float(-beta[1] / slope)


def fit(rows: list[np.ndarray], labels: list[int], ratios: np.ndarray) -> Model:
    """Model of a sample's buckets by row; every fifth row is held back for the logistic fit."""
    y = np.array(labels)
    back = np.arange(len(y)) % 5 == 4
    if len(set(y[~back].tolist())) < 2 or not back.any():
        back[:] = False
    signs = np.where(y[~back] > 0, 1.0, -1.0)
    weights, bias = dual_coordinate_descent(
        [r for r, b in zip(rows, back, strict=True) if not b], signs, ratios
    )
    model = Model(weights * ratios, bias, 1.0, 0.0)
    sums = np.array([(weights[r] * ratios[r]).sum() / np.sqrt(max(len(r), 1)) for r in rows]) + bias
    use = back if back.any() else ~back
    model.slope, model.middle = _logistic(sums[use], y[use].astype(float))
    return model


def class_counts(training: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows by class and bucket, and rows by class, of all of ``training`` (``text``, ``label``)."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # behind the buckets of both classes stand the numbers of their rows
        total = np.zeros(2 * WIDTH + 2, np.int64)
        for batch in batches(rows, 1 << 20):
            buckets, bounds = features(batch.column("text"))
            labels = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            of = np.repeat(labels, np.diff(bounds))
            total[:-2] += np.bincount(of * WIDTH + buckets, minlength=2 * WIDTH)
            total[-2:] += np.bincount(labels, minlength=2)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place.astype(np.int32)), pa.array(total[place])], names=["place", "n"]
        )

    sums = training.select("text", "label").mapInArrow(count, "place int, n long")
    # at most two times WIDTH rows
    found = stored(sums.groupBy("place").agg(F.sum("n").alias("n"))).toArrow()
    out = np.zeros(2 * WIDTH + 2)
    out[found["place"].to_numpy()] = found["n"].to_numpy()
    return out[:-2].reshape(2, WIDTH), out[-2:]


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> pa.Table:
    """``label`` and ``buckets`` of at most ``rows`` labelled rows, those with the least hashes of

    their ids. The sample is drawn from the keys alone, of labels that have a document; the ids
    that are drawn (a bounded number) are broadcast to the documents.
    """
    hashed = F.xxhash64("doc_id")
    keys = docs.select("doc_id").join(labels, "doc_id").select("doc_id", "label").distinct()
    chosen = keys.orderBy(hashed, "label").limit(rows)
    found = docs.join(F.broadcast(stored(chosen)), "doc_id").select(
        hashed.alias("hash"), F.xxhash64("text").alias("text_hash"), "text", "label"
    )

    def extract(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1 << 20):
            buckets, bounds = features(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(buckets))
            names = ["hash", "text_hash", "label"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], lists], names=[*names, "buckets"]
            )

    found = found.mapInArrow(extract, "hash long, text_hash long, label int, buckets array<int>")
    return found.orderBy("hash", "label", "text_hash").limit(rows).select("label", "buckets").toArrow()


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Model:
    """Model from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``label``, 0 or 1).

    ``rows`` bounds the sample of the linear model, not the counts. Texts and labels are joined by
    the same plan at every size: both shuffled, the labels of a partition hashed.
    """
    labels = labels.distinct()
    counts, sizes = class_counts(docs.join(labels.hint("shuffle_hash"), "doc_id"))
    if not sizes.all():
        share = (sizes[1] + 0.5) / (sizes.sum() + 1)
        return Model(np.zeros(WIDTH), 0.0, 1.0, -float(np.log(share / (1 - share))))
    sample = labelled_sample(docs, labels, rows).combine_chunks()
    lists = sample["buckets"].combine_chunks()
    bounds = lists.offsets.to_numpy()
    buckets = np.split(lists.values.to_numpy(), bounds[1:-1])
    return fit(buckets, sample["label"].to_pylist(), log_ratios(counts))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of every row of ``docs`` (``doc_id``, ``text``)."""
    weights = docs.sparkSession.sparkContext.broadcast(
        Model(model.weights.astype(np.float32), model.bias, model.slope, model.middle)
    )

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1 << 20):
            found = weights.value.scores(*features(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    ``labels`` has ``doc_id`` and ``label``. Rows whose id's crc32 is divisible by ``folds`` are
    held out: their labels are not used. A document with several labels is used with each.
    """
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(True))
    known = labels.where(~out & F.col("label").isin(0, 1)).select("doc_id", F.col("label").cast("int"))
    model = train(docs.select("doc_id", "text"), known)
    return score(docs, model).select(
        "doc_id",
        out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
