import random
import re
import zlib
from collections import Counter

import pytest

from llm.conftest import EDGES
from tierflow.llm import spelling
from tierflow.llm.spelling import (
    SortedWords,
    reach,
    shared_start,
    spelling_variants,
    start_within_an_edit,
    vocabulary,
)

LETTERS = "abé÷xyz"


def plain_words(rows):
    """Counts by the definition, run by run."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    """Whether the whole edit matrix ends in 1."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1] == 1


def edits(word, letters):
    """All strings that one inserted, deleted or replaced letter makes of the word."""
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    made = {a + c + b for a, b in cuts for c in letters} | {a + b[1:] for a, b in cuts if b}
    return (made | {a + c + b[1:] for a, b in cuts if b for c in letters}) - {word}


def plain_groups(n):
    letters = {c for w in n for c in w}
    near = {w: [o for o in edits(w, letters) if o in n] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def rows_of(frame):
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def family(rng, words, n):
    """Texts of words and their edits, some words often, so that forms have forms."""
    out = []
    for i in range(n):
        texts = []
        for _ in range(40):
            word = rng.choice(words[: 1 + int(len(words) * rng.random() ** 3)])
            if rng.random() < 0.3:
                at = rng.randrange(len(word) + 1)
                kind = rng.randrange(3)
                word = word[:at] + (rng.choice(LETTERS) if kind else "") + word[at + (kind < 2) :]
            texts.append(rng.choice([word, word.upper(), word.title()]))
        out.append((i, rng.choice([" ", ", ", "-", "7"]).join(texts)))
    return out


@pytest.fixture
def texts():
    rng = random.Random(9)
    words = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(4, 9))) for _ in range(120)]
    long = ["internationalisation" + "".join(rng.choice("ab") for _ in range(6)) for _ in range(60)]
    return family(rng, words, 150) + [(1000 + i, t) for i, t in family(rng, long, 60)]


def test_counts_by_the_definition(docs, texts):
    rows = [*EDGES, *texts]
    got = {r.word: r.n for r in vocabulary(docs(rows).repartition(3)).collect()}
    assert got == plain_words(rows)


@pytest.mark.parametrize("block", [4, 64, 2048])
def test_groups_by_the_definition(docs, texts, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    expected = plain_groups(plain_words(texts))
    assert sum(r[1] is not None for r in expected) > 50 and any(r[2] != r[1] for r in expected if r[1])
    assert rows_of(spelling_variants(docs(texts).repartition(2))) == expected


def test_near_words_by_the_whole_matrix():
    rng = random.Random(4)
    for _ in range(60):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(80)})
        shared = [0, *[shared_start(a, b) for a, b in zip(words, words[1:])]]
        n = rng.randrange(1, 9)
        queries = ["".join(rng.choice("abc") for _ in range(n)) for _ in range(20)]
        queries += [w for w in words if len(w) == n]
        found = zip(*(x.tolist() for x in SortedWords(words, shared).near(queries)))
        expected = [
            (i, k) for i, q in enumerate(queries) for k, w in enumerate(words)
            if w.startswith(reach(q)) and one_edit(q, w)
        ]
        assert sorted(found) == expected


def test_beginnings_within_an_edit():
    rng = random.Random(7)
    for _ in range(2000):
        query, prefix = ("".join(rng.choice("ab") for _ in range(rng.randrange(1, 7))) for _ in range(2))
        # whether some word that begins with the prefix is one edit or none from the query
        cuts = [query[:i] for i in range(len(query) + 1)]
        expected = any(prefix == c or one_edit(prefix, c) for c in cuts)
        assert start_within_an_edit(query, prefix) == expected


def test_chains_of_forms_are_followed_to_their_end(docs):
    """Counts 3, 6, 12, ... of words that each differ from the next in one letter."""
    words = ["aaaaaaaaaaaa"[:i] + "bbbbbbbbbbbb"[i:] for i in range(11)]
    texts, expected = [], 3
    for word in words:
        texts.append((None, " ".join([word] * expected)))
        expected *= 2
    rows = {r.word: r for r in spelling_variants(docs(texts)).collect()}
    kept = plain_words(texts)
    assert plain_groups(kept) == rows_of(spelling_variants(docs(texts)))
    assert len({r.root for r in rows.values()}) < len(rows)


def test_given_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    expected = plain_words([tuple(r) for r in table.collect()])
    words = {r.word: r.n for r in vocabulary(table).collect()}
    assert words == expected
    assert rows_of(spelling_variants(table)) == plain_groups(expected)


def test_empty_table(docs):
    assert spelling_variants(docs([]).where("false")).count() == 0
    assert spelling_variants(docs([(1, None), (2, "few")])).count() == 0
