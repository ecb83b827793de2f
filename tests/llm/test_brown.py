import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import EDGES
from tierflow.llm import brown

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def held(i):
    return i is None or zlib.crc32(str(i).encode()) % 10 == 0


def two_languages(n):
    """Texts whose words come from one of two vocabularies."""
    rng = np.random.default_rng(2)
    out = []
    for i in range(n):
        names = [f"{'ab'[i % 2]}{k}" for k in range(200)]
        out.append((100 + i, " ".join(names[int(k)] for k in rng.zipf(1.3, 80) if k < 200)))
    return out


def test_base_score_by_formula(docs):
    rows = [*EDGES, *two_languages(60), (9000, "Unseen words onlyhere")]
    found = brown.class_scores(docs(rows)).collect()
    assert len(found) == len(rows)
    counts = collections.Counter()
    for i, t in rows:
        if not held(i):
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    for r in found:
        words = tokens(texts[r.doc_id][0])
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert (r.n_tokens, r.n_known) == (len(words), sum(counts[w] > 0 for w in words))
        assert r.train_tokens == n and r.held_out == held(r.doc_id)
        assert math.isfinite(r.score) and r.score < 0
        assert r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))


def test_held_out_texts_beat_the_base(docs):
    found = [r for r in brown.class_scores(docs(two_languages(400))).collect() if r.held_out]
    assert len(found) > 20
    assert sum(r.score for r in found) > sum(r.base_score for r in found) + 5 * len(found)


def test_sweeps_raise_the_likelihood(docs):
    """Mutual information of neighbouring classes, which is what exchange maximises."""
    corpus = brown.chunks(docs(two_languages(300)).selectExpr("doc_id", "text", "false AS held"))
    seen = brown.occurrences(corpus).groupBy("h")
    known = brown.vocabulary(seen.agg(F.first("tail").alias("tail"), F.sum("n").alias("c")))
    values = []
    for _ in range(4):
        counts = brown.neighbours(corpus, known, words=True)
        pairs = brown._pairs(counts)
        p = pairs / pairs.sum()
        inside = p > 0
        values.append((p[inside] * np.log(p / (p.sum(1)[:, None] * p.sum(0)))[inside]).sum())
        known.classes = brown.exchanged(counts, known, pairs)
    assert values[-1] > values[0] + 0.05 and min(values[1:]) > values[0]


def test_probabilities_sum_to_one(docs):
    pairs = np.random.default_rng(0).integers(0, 50, (brown.CLASSES, brown.CLASSES)).astype(float)
    assert (10 ** brown.transitions(pairs)).sum(axis=1) == pytest.approx(np.ones(brown.CLASSES))


def test_no_training_and_empty(docs):
    only_held = [(i, "some words") for i in range(200) if held(i)]
    found = brown.class_scores(docs(only_held)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in found)
    assert brown.class_scores(docs(EDGES).where("false")).count() == 0


def test_scores_by_formula(docs, monkeypatch):
    """Class transitions and emissions counted token by token, for the classes that were found."""
    rows = [*two_languages(120), (9000, "Unseen words onlyhere"), (9001, "a1 rareonce b2 rareonce"), (9002, "")]
    kept = {}
    score = brown.score
    monkeypatch.setattr(brown, "score", lambda c, a, known, k: kept.update(known=known) or score(c, a, known, k))
    found = {r.doc_id: r.score for r in brown.class_scores(docs(rows)).collect()}
    known = kept["known"]

    import pyarrow as pa

    def looked_up(text):
        hashes, tails, _ = brown.tokens_of(pa.array([text]))
        number = known.number(hashes)
        return list(zip(tokens(text), number.tolist(), known.classes_of(number, hashes, tails).tolist()))

    train = [looked_up(t) for i, t in rows if not held(i)]
    counts = collections.Counter(w for text in train for w, _, _ in text)
    size, once = collections.Counter(), collections.Counter()
    pairs = np.zeros((brown.CLASSES, brown.CLASSES))
    for text in train:
        for (_, _, a), (_, _, b) in zip([(None, -1, 0), *text], text):
            pairs[a, b] += 1
        size.update(c for _, _, c in text)
    for w, c in {(w, c) for text in train for w, n, c in text if n < 0 and w is not None}:
        once[c] += counts[w] == 1
    share = (pairs.sum(0) + 1) / (pairs.sum() + brown.CLASSES)
    for i, t in rows:
        total, before = 0.0, 0
        for w, number, c in looked_up(t):
            move = (pairs[before, c] + brown.PRIOR * share[c]) / (pairs[before].sum() + brown.PRIOR)
            if w is None:
                inside = 1.0
            elif number >= 0:
                inside = counts[w] / size[c]
            else:
                left = (once[c] + 0.5) / (size[c] + 1)
                inside = counts[w] / size[c] * (1 - left) if counts[w] else left
            total += math.log10(move * inside)
            before = c
        assert found[i] == pytest.approx(total, rel=1e-9), t


def test_the_same_words_are_exchanged_whatever_the_corpus(spark):
    """Words seen 5 times are, also where they are less than a millionth of all tokens."""
    words = [(1, 0, 500_000_000), (2, 3, 5), (3, 3, 4), (4, 3, 1), (int(brown.END.astype(np.int64)), 3, 9)]
    known = brown.vocabulary(spark.createDataFrame(words, "h long, tail int, c long"))
    assert known.rare[:, 3].tolist() == [5, 1] and known.rare.sum() == 6
    assert (known.n, known.v) == (500_000_019, 5) and known.first.tolist() == [1, 2]


def test_many_buckets_give_the_scores_of_one(docs, monkeypatch):
    rows = docs([*EDGES, *two_languages(80), (9000, "Unseen words onlyhere")]).repartition(5)

    def scores():
        return sorted(map(str, (tuple(r) for r in brown.class_scores(rows).collect())))

    expected = scores()
    for name, value in (("CHUNK", 4000), ("BUCKET", 64), ("SPAN", 3), ("DENSE", 0)):
        monkeypatch.setattr(brown, name, value)
    assert [r.replace("nan", "") for r in scores()] == expected


def test_large_rows_are_few_in_a_row_group(spark, docs, monkeypatch, tmp_path):
    """Row groups end by size, not by 100 rows, as writers and readers hold them whole."""
    import glob

    import pyarrow.parquet as pq

    from tierflow.llm import common

    monkeypatch.setattr(common, "shared_root", lambda spark: str(tmp_path))
    large = "array_join(transform(sequence(1, 30000), i -> uuid()), '') AS text"
    texts = docs([(i, "x") for i in range(60)]).selectExpr("doc_id", large).repartition(1)
    assert common.stored(texts, large=True).count() == 60
    (file,) = glob.glob(f"{tmp_path}/*/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups >= 3
