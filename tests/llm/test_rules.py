import collections
import re

import pytest
from pyspark.sql import functions as F

from llm.conftest import EDGES
from tierflow.llm import rules
from tierflow.llm.common import packed

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, covered = collections.Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


CASES = [
    "a a a a", "a b c a b c", "a b a b a b x", "one\none\n \none ", "#x *y\n\n$%&|<>", "a b", "a b c",
    "x y z " * 3 + "q", " nbsp is no space\x0bhere is\x1cone",
]


def test_counts_equal_brute_force(docs):
    rows = [*EDGES, *enumerate(CASES, 100)]
    found = docs(rows).select("doc_id", "text").select(
        "text", *[c.alias(n) for n, c in rules.text_counts(F.col("text")).items()]
    )
    for r in found.collect():
        expected = brute(r.text)
        assert {k: r[k] for k in expected} == expected, (r.text or "")[:40]


def prose(i, n=120):
    """Different words with little spread in length."""
    return " ".join(f"w{(i * 7919 + j * 104729) % 99991:05d}" for j in range(n)).capitalize() + "."


def test_outliers_go_and_clean_rows_stay(docs):
    clean = [(i, prose(i, 60 + i)) for i in range(120)]
    junk = [(1000 + i, " ".join(f"{w}$$$" for w in prose(i).split())) for i in range(12)]
    loud = [(2000 + i, " ".join(f"{w.upper()}!!" for w in prose(i).replace("w", "Wxy").split())) for i in range(12)]
    short = [(3000, prose(1, 49)), (3001, "again and again " * 40)]
    found = {
        r.doc_id: r
        for r in rules.quality_rules(docs([*clean, *junk, *loud, *short]).select("doc_id", "text", "lang", "source")).collect()
    }
    assert all(found[i].kept for i, _ in clean)
    assert not any(found[i].kept or found[i].base_failed for i, _ in [*junk, *loud])
    assert found[3000].base_failed and found[3001].base_failed
    assert found[3000].distance is None


def test_edges_and_clashing_columns(docs):
    given = docs([*EDGES, *[(100 + i, prose(i)) for i in range(60)]])
    back = rules.quality_rules(packed(given, "text", "lang", "source"))
    assert back.count() == given.count()
    kept = back.where("kept").select("row.*")
    assert kept.columns == given.columns and {r.doc_id for r in kept.collect()} == set(range(100, 160))
    assert rules.quality_rules(given.where("false").select("doc_id", "text", "lang", "source")).count() == 0


def test_null_groups_are_groups(spark):
    rows = [(i, prose(i), None, None if i % 2 else "s") for i in range(140)]
    found = rules.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    )
    assert found.where("kept").count() == 140


def test_chi_square():
    assert rules._chi_square(12.592, 6) == pytest.approx(0.95, abs=1e-4)
    assert rules._chi_quantile(0.5, 6) == pytest.approx(5.348, abs=1e-3)


def plain_estimate(x, floors, p):
    """Medians, concentration steps and reweighting with numpy, on whole covariance matrices."""
    import numpy as np

    def middle(values, share=0.5):
        return np.sort(values, axis=0)[int(np.ceil(share * len(values))) - 1]

    floor = np.diag(np.square(floors))
    mean = middle(x)
    cov = np.diag((middle(np.abs(x - mean)) * 1.4826) ** 2) + floor
    far = lambda: np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
    inner = rules.KEPT_SHARE / rules._chi_square(rules._chi_quantile(rules.KEPT_SHARE, p), p + 2)
    for step in range(rules.STEPS + 1):
        d = far()
        if step < rules.STEPS:
            near, scale = x[d <= middle(d, rules.KEPT_SHARE)], inner
        else:
            most = rules._chi_quantile(0.975, p)
            near, scale = x[d <= most], 0.975 / rules._chi_square(most, p + 2)
        mean, cov = near.mean(axis=0), np.cov(near.T, bias=True) * scale + floor
    return mean, far()


def test_estimates_equal_those_of_numpy(spark):
    import numpy as np

    names = list(rules.STATS)
    floors = [rules.STATS[n] for n in names]
    rng = np.random.default_rng(3)
    cells = {}
    for cell in ("a", "b"):
        mixed = rng.normal(size=(6, 6)) * 0.3
        x = rng.normal(size=(150, 6)) @ mixed + rng.normal(size=6)
        x[:30] += rng.normal(size=(30, 6)) * 4 + 5  # a fifth of the rows lies elsewhere
        cells[cell] = x
    rows = [(c, *map(float, r)) for c, x in cells.items() for r in x]
    columns = ", ".join(f"s_{n} double" for n in names)
    df = spark.createDataFrame(rows, f"cell string, {columns}")
    estimates = rules.robust_estimates(df, names)
    found = df.join(estimates, "cell").withColumn("d", rules._distance(names)).collect()
    for cell, x in cells.items():
        mean, d = plain_estimate(x, floors, len(names))
        own = [r for r in found if r.cell == cell]
        assert [own[0][f"m_{n}"] for n in names] == pytest.approx(list(mean), rel=1e-6)
        by_row = {tuple(round(r[f"s_{n}"], 9) for n in names): r.d for r in own}
        assert [by_row[tuple(round(float(v), 9) for v in row)] for row in x] == pytest.approx(list(d), rel=1e-6)
        assert np.median(d[:30]) > 20 * np.median(d[30:])
