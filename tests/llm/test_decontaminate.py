from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import EDGES
from tierflow.llm import decontaminate as D

TABLE = str.maketrans("", "", D.PUNCTUATION)


def shingles(text):
    words = (text or "").lower().translate(TABLE).split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} - {()})


def brute(docs, items):
    out = {}
    for d, text in docs:
        have = shingles(text)
        for i, item in items:
            want = shingles(item)
            if want and len(want & have) >= 0.8 * len(want):
                key = (d, i)
                out[key] = max(out.get(key, 0), len(want & have))
    return out


def text(seed, n):
    return " ".join(f"t{(seed * 31 + j * 17) % 997}" for j in range(n))


ITEMS = [(0, text(1, 14)), (1, text(2, 60) + "."), (2, text(3, 400)), (3, "Tiny item"), (4, None), (5, ""),
         (6, text(1, 14)), (None, text(9, 20))]


def test_equals_brute_force(spark, docs):
    whole = [item for _, item in ITEMS[:3]]
    rows = [
        *EDGES,
        (10, text(50, 300) + " " + whole[0] + " " + text(60, 300)),
        (11, whole[1].upper().replace(" ", ", ")),
        (12, " ".join(whole[1].split()[:50]) + " other words"),
        (13, " ".join(whole[1].split()[:30])),
        (14, whole[2] + text(70, 5000)), (15, "tiny ITEM!"), (16, "a tiny item"),
        (17, text(9, 20)), (17, "nothing"), (18, whole[0] + " " + whole[1]), (18, whole[0] + " " + whole[1]),
    ]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = D.find_contamination(docs(rows).select("doc_id", "text"), items).collect()
    assert {(r.doc_id, r.item_id): r.found for r in found} == brute(rows, ITEMS)
    assert len(found) == len({(r.doc_id, r.item_id) for r in found})
    small = D.find_contamination(docs(rows).select("doc_id", "text"), items, sketch=2)
    assert {(r.doc_id, r.item_id) for r in small.collect()} == set(brute(rows, ITEMS))


def test_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    pair = docs(EDGES).select("doc_id", "text")
    assert D.find_contamination(pair.where("false"), items).count() == 0
    assert D.find_contamination(pair, items.where("false")).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=30))
def test_shingle_counts(words):
    assert len(shingles(" ".join(words))) <= max(1, len(words) - 4)
