import collections

import numpy as np
import pyarrow as pa
import pytest

from llm.conftest import EDGES
from tierflow.llm import neardup as N
from tierflow.llm.common import packed, shingle_hashes, word_hashes


def words(seed, n):
    return [f"w{(seed * 7919 + j * 31337) % 65537}" for j in range(n)]


def edited(base, *places):
    out = list(base)
    for p in places:
        out[p] = f"edit{p}"
    return out


def runs(text):
    w = (text or "").lower().split()
    return collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or collections.Counter([tuple(w)] if w else [])


def jaccard(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def brute(rows):
    """Classes of row numbers: equal texts, or chains of runs at least 0.8 alike."""
    sets = [runs(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if same or (sets[i] and jaccard(sets[i], sets[j]) >= 0.8):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    groups = collections.defaultdict(list)
    for i, x in enumerate(label):
        groups[x].append(i)
    return groups.values()


def test_hashes_of_words_depend_on_the_word_alone():
    texts = pa.array(["a bc  def", None, "", "DEF a", "bc"])
    hashes, bounds = word_hashes(texts)
    assert bounds.tolist() == [0, 3, 3, 3, 5, 6]
    assert hashes[0] == hashes[4] and hashes[2] == hashes[3] and hashes[1] == hashes[5]
    assert len(set(hashes.tolist())) == 3
    grams, ends = shingle_hashes(hashes, bounds, 2)
    assert ends.tolist() == [0, 2, 2, 2, 3, 4]


def test_samples_are_the_same_in_pieces_of_any_size(monkeypatch):
    rng = np.random.default_rng(4)
    sizes = [3, 0, 1, 700, 0, 40, 2, 0]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    hashes = rng.integers(1, 2**63, bounds[-1]).astype(np.uint64)
    counts = rng.integers(1, 3, bounds[-1])
    few = np.where(rng.random(bounds[-1]) < 0.1, 0.5, 1.0)
    whole = N.samples_of_each(hashes, [few, counts], bounds)
    for size in (1, 50, 741):
        monkeypatch.setattr(N, "PIECE", size)
        for x, y in zip(whole, N.samples_of_each(hashes, [few, counts], bounds), strict=True):
            assert x.shape == (5, N.SAMPLES) and (x == y).all()
    own = [N.samples(hashes[i:j], few[i:j], np.array([0, j - i])) for i, j in zip(bounds, bounds[1:]) if i < j]
    assert (np.concatenate(own) == whole[0]).all()


def test_samples_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(1)
    universe = rng.integers(1, 2**63, 400).astype(np.uint64)
    a, b = universe[:300], universe[100:]
    wa, wb = rng.uniform(0.2, 3, 300), rng.uniform(0.2, 3, 300)
    wb[:200] = np.where(rng.random(200) < 0.7, wa[100:], wb[:200])
    both = np.minimum(wa[100:], wb[:200]).sum()
    true = both / (wa.sum() + wb.sum() - both)
    found = N.samples(np.concatenate([a, b]), np.concatenate([wa, wb]), np.array([0, 300, 600]), 2000)
    assert (found[0] == found[1]).mean() == pytest.approx(true, abs=0.04)


def test_similarities_are_weighted_jaccard():
    texts = ["a b c d e f", "a b c d e f a b c d e f", "a b c d e g", "x", ""]
    h, c, bounds = N.weighted_sets(pa.array(texts))
    found = N.similarities(h, c, np.ones(len(h)), bounds)
    sets = [runs(t) for t in texts]
    for i in range(4):  # with itself a set isn't compared
        for j in range(i):
            assert found[i, j] == pytest.approx(jaccard(sets[i], sets[j]), abs=1e-6)


def classes(df):
    groups = collections.defaultdict(list)
    for r in df.collect():
        groups[r.class_id].append(r.doc_id)
    return {tuple(sorted(x)) for x in groups.values()}


@pytest.fixture
def group():
    """Copies with growing numbers of edits, a chain, exact copies, and others."""
    base, chain = words(1, 80), words(2, 90)
    rows = [(i, " ".join(edited(base, *range(0, 10 * (i % 4), 10), 70 - i))) for i in range(24)]
    rows += [(100 + i, " ".join(edited(chain, *range(0, 8 * i, 8)))) for i in range(6)]
    rows += [(200 + i, " ".join(words(3, 40))) for i in range(7)]
    rows += [(300 + i, " ".join(words(10 + i, 60))) for i in range(20)]
    rows += [(400, "a few words"), (401, "A  few words"), (402, "few words a")]
    return rows


@pytest.mark.parametrize("block", [4, 256])
def test_equals_brute_force(docs, group, block, monkeypatch):
    """With small blocks the members outside the largest class are compared in a second step."""
    monkeypatch.setattr(N, "BLOCK", block)
    expected = {tuple(sorted(group[i][0] for i in g)) for g in brute(group)}
    found = N.near_duplicates(docs(group))
    assert classes(found) == expected
    assert all(r.class_rows == len([g for g in expected if r.doc_id in g][0]) for r in found.collect())


def test_edges(docs):
    rows = [*EDGES, (50, ""), (51, " \n\t ")]
    found = N.near_duplicates(docs(rows)).collect()
    assert len(found) == len(rows)
    by = collections.defaultdict(set)
    for r in found:
        by[r.doc_id].add(r.class_id)
    assert by[1] == by[2] == by[50] == {1} and by[3] == by[51] == {3}
    assert by[8] == by[9] == {8} and by[None] == {None} and by[4] == {4}
    assert N.near_duplicates(docs(EDGES).where("false")).count() == 0


def test_one_of_each_keeps_columns_and_one_row(docs, group):
    given = docs([*EDGES, *group])
    kept = N.one_of_each(packed(given, "doc_id", "text")).select("row.*")
    assert kept.columns == given.columns
    ids = [r.doc_id for r in kept.collect()]
    expected = sorted(
        (min((i for i in (rows[k][0] for k in g) if i is not None), default=-1))
        for rows in ([*EDGES, *group],)
        for g in brute(rows)
    )
    assert sorted(-1 if i is None else i for i in ids) == expected


def test_common_runs_weigh_less(spark):
    line = "a line that stands in most of all the documents here"
    rows = [(i, (line if i % 10 else "") + " " + " ".join(words(i, 20))) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = N.common_runs(df, 3000)
    grams, _ = shingle_hashes(*word_hashes(pa.array([line])))
    assert set(found) == set(grams.view(np.int64).tolist())
    expected = np.log(4000 / 2700) / np.log(4)
    assert all(w == pytest.approx(expected) for w in found.values())
    assert N.common_runs(df.limit(20), 20) == {}


def test_components(spark):
    rng = np.random.default_rng(5)
    for n, m in ((30, 20), (40, 60)):
        pairs = [(int(a), int(b)) for a, b in rng.integers(0, n, (m, 2))] + [(i, i + 1) for i in range(100, 120)]
        label = {}
        for a, b in pairs:
            x, y = label.get(a, a), label.get(b, b)
            label |= {k: min(x, y) for k in [a, b, *[k for k, v in label.items() if v in (x, y)]]}
        links = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in pairs], "a binary, b binary")
        found = {r.key[0]: r["class"][0] for r in N.components(links).collect()}
        linked = {k for a, b in pairs if a != b for k in (a, b)}
        assert found == {k: v for k, v in label.items() if k in linked}


@pytest.mark.parametrize("total, share", [(3000, 2), (6000, 3)])
def test_pairs_in_a_group_of_a_half_and_a_third(docs, total, share):
    """Pairs just above the similarity whose common runs weigh less are linked, as by brute force."""
    core, size = words(1, 60), total // share
    rows = [
        (i, " ".join([*core, *[f"both{i // 2}x{j}" for j in range(34)], *[f"own{i}x{j}" for j in range(11)]]))
        for i in range(size)
    ]
    sets = [frozenset(runs(t)) for _, t in rows]
    alike = lambda a, b: len(a & b) / len(a | b)
    pairs = [(i, i + 1) for i in range(0, size, 2)]
    assert all(0.8 <= alike(sets[i], sets[j]) < 0.81 for i, j in pairs)
    expected = {
        (i, j) for i in range(size) for j in range(i + 1, size) if alike(sets[i], sets[j]) >= 0.8
    }
    assert expected == set(pairs)
    rest = [(i, " ".join(f"rest{i}x{j}" for j in range(20))) for i in range(size, total)]
    found = classes(N.near_duplicates(docs([*rows, *rest])))
    assert {x for x in found if x[0] < size} == expected


def test_runs_far_below_a_quarter_weigh_less(spark):
    """Runs of a 100th and a 20th of all documents; counts are exact but for the sketch's collisions."""
    lines = {20: "a line that stands in some of the documents here", 100: "another line which only few other ones have"}
    rows = [(i, " ".join([x for n, x in lines.items() if i % n == 0] + words(i, 20))) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    idf = N.Weights(df, 4000)
    assert not N.common_runs(df, 4000)
    for n, line in lines.items():
        grams, _ = shingle_hashes(*word_hashes(pa.array([line])))
        expected = np.log(5000 / (4000 / n)) / np.log(4096)
        assert idf.of(grams) == pytest.approx(expected, abs=0.02)
    own, _ = shingle_hashes(*word_hashes(pa.array([" ".join(words(7, 20))])))
    assert idf.of(own).min() > 0.85


def test_pair_that_differs_in_frequent_runs_only_is_linked(docs):
    """Its plain similarity is below 0.8, the weighted one above; the runs are in a 20th of the documents."""
    own, line = words(70001, 40), [f"frequent{j}" for j in range(14)]
    rows = [(1, " ".join(own)), (2, " ".join([*own, *line]))]
    rows += [(i, " ".join([f"rest{i}x{j}" for j in range(20)] + (line if i % 20 == 0 else []))) for i in range(10, 6010)]
    a, b = runs(rows[0][1]), runs(rows[1][1])
    assert jaccard(a, b) < 0.8
    assert (1, 2) in classes(N.near_duplicates(docs(rows)))
