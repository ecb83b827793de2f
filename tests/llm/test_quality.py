import numpy as np
import pyarrow as pa
import pytest

from llm.conftest import EDGES
from tierflow.llm import quality as Q


def good(i):
    return " ".join(f"word{(i * 31 + j * 17) % 400}" for j in range(40))


def bad(i):
    return " ".join(f"w{(i * 31 + j * 17) % 400}***" for j in range(40))


def test_features_are_a_text_s_own():
    texts = ["a b a b", None, "", "a b", "x" * 50]
    buckets, bounds = Q.features(pa.array(texts))
    for i, t in enumerate(texts):
        alone, _ = Q.features(pa.array([t], pa.string()))
        assert buckets[bounds[i] : bounds[i + 1]].tolist() == alone.tolist()
        assert len(set(alone.tolist())) == len(alone)
    assert bounds[2] == bounds[1] == bounds[3]


def test_dual_coordinate_descent_reaches_the_optimum():
    """The gradient of the primal objective vanishes: w = sum of 2 C max(0, 1 - margin) y x."""
    rng = np.random.default_rng(4)
    rows = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(60)]
    ratios = rng.normal(size=30)
    signs = np.where(rng.random(60) < 0.5, 1.0, -1.0)
    w, bias = Q.dual_coordinate_descent(rows, signs, ratios, passes=800)
    x = np.zeros((60, 30))
    for i, r in enumerate(rows):
        x[i, r] = ratios[r] / np.sqrt(6)
    share = np.where(signs > 0, (signs > 0).mean(), (signs < 0).mean())
    slack = 2 * Q.COST / (2 * share) * np.maximum(0, 1 - signs * (x @ w + bias)) * signs
    assert w == pytest.approx(x.T @ slack, abs=1e-4) and bias == pytest.approx(slack.sum(), abs=1e-4)


def test_held_out_accuracy(spark, docs):
    rows = [*EDGES, *[(100 + i, good(i) if i % 4 else bad(i)) for i in range(600)]]
    labels = [(100 + i, 1 if i % 4 else 0) for i in range(600)] + [(1, 1), (None, 0), (2, None), (3, 7)]
    found = Q.classify(docs(rows), spark.createDataFrame(labels, "doc_id long, label int")).collect()
    assert len(found) == len(rows)
    truth = dict(labels)
    out = [r for r in found if r.held_out and (r.doc_id or 0) >= 100]
    assert len(out) > 60 and all(r.predicted == truth[r.doc_id] for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)


def test_labels_of_held_out_rows_are_not_used(spark, docs):
    rows = [(i, good(i) if i % 2 else bad(i)) for i in range(300)]
    df = docs(rows)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, label int")
    first = {r.doc_id: r for r in Q.classify(df, labels).collect()}
    wrong = [(i, (i % 2) ^ int(first[i].held_out)) for i, _ in rows]
    second = Q.classify(df, spark.createDataFrame(wrong, "doc_id long, label int")).collect()
    assert all(r.score == pytest.approx(first[r.doc_id].score) for r in second)


@pytest.mark.parametrize("value, score", [(1, 0.98), (0, 0.02), (None, 0.5)])
def test_without_both_classes(spark, docs, value, score):
    rows = [(i, good(i)) for i in range(40)]
    labels = spark.createDataFrame([(i, value) for i in range(40)], "doc_id long, label int")
    found = Q.classify(docs(rows), labels).collect()
    assert all(r.score == pytest.approx(score, abs=0.02) for r in found)
    assert Q.classify(docs(rows).where("false"), labels).count() == 0


def test_ratios_count_all_labelled_rows(spark, docs):
    """Every labelled row is counted, whatever the sample of the linear model."""
    rows = [(i, good(i) if i % 2 else bad(i)) for i in range(300)]
    labels = [(i, i % 2) for i in range(300)] + [(i, 1) for i in range(1000, 1400)]
    df, known = docs(rows), spark.createDataFrame(labels, "doc_id long, label int")
    expected = np.zeros((2, Q.WIDTH))
    for i, text in rows:
        expected[i % 2, Q.features(pa.array([text]))[0]] += 1
    counts, sizes = Q.class_counts(df.join(known, "doc_id"))
    assert (counts == expected).all() and sizes.tolist() == [150, 150]

    # the sample is drawn from labels that have a document, and doesn't bound the counts
    sample = Q.labelled_sample(df, known, 200)
    assert sample.num_rows == 200
    model = Q.train(df, known, 20)
    seen = np.flatnonzero(expected.sum(axis=0))
    few = Q.labelled_sample(df, known, 20)["buckets"].to_pylist()
    assert set(np.flatnonzero(model.weights)) <= set(sum(few, [])) < set(seen.tolist())
    ratios = Q.log_ratios(expected)
    whole = Q.fit([np.array(x, np.int32) for x in few], Q.labelled_sample(df, known, 20)["label"].to_pylist(), ratios)
    assert model.weights == pytest.approx(whole.weights)
