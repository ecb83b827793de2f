import collections
import itertools
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import EDGES
from tierflow.llm import packing
from tierflow.llm.common import tokenizer_files

tokenizers = pytest.importorskip("tokenizers")
FILES = tokenizer_files()
WHOLE = tokenizers.Tokenizer.from_file(FILES["vocabulary"])
ENCODER = packing.Encoder(**FILES)


def plain(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, packing.END]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(
    ["a", "Word", "don't", "12", " ", "  ", "\n", "\n\n", "\t", "é", "日本", " ", " ", ",", "!!", "\x00",
     "<|endoftext|>", "\r\n", "😀", "'s", "x1"]), max_size=8).map("".join), max_size=6))
def test_ids_equal_those_of_the_tokenizer(texts):
    ids, bounds = ENCODER.encode(pa.array([*texts, None], pa.string()))
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(bounds)] == [plain(t) for t in [*texts, None]]


def test_a_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr(packing, "MEMORY", 5)
    encoder = packing.Encoder(**FILES)
    for text in ("a b c d e f g", "h i j a b", "c d a x"):
        assert encoder.encode(pa.array([text]))[0].tolist() == plain(text)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_the_curve_visits_neighbours(bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=3)))
    keys = packing.hilbert_keys(points, bits)
    assert sorted(keys) == list(range(1 << 3 * bits))
    steps = np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_like_texts_have_near_keys():
    a, b = np.zeros((2, packing.WIDTH))
    a[:20], b[:21] = 3, 3
    c = np.zeros(packing.WIDTH)
    c[100:130] = 3
    near, mid, far = packing.curve_key(np.array([a, b, c]), packing.projection())
    assert abs(int(near) - int(mid)) < abs(int(near) - int(far))


def check(rows, texts, length):
    """Each id in exactly one piece; sequences gapless and full, or a power of two."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids, copies = plain(texts[doc][0]), len(texts[doc])
        seen = collections.Counter()
        for r in pieces:
            assert r.doc_tokens == len(ids)
            part = ids[r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *part))
            seen.update(range(r.start, r.start + r.length))
        assert seen == {i: copies for i in range(len(ids))}
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length and at & (at - 1) == 0


def test_pack(docs):
    rows = [(i, t) for i, t in EDGES if i is not None]
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    for length in (8, 2048):
        check(packing.pack(docs(rows), **FILES, length=length).collect(), texts, length)
    assert packing.pack(docs(EDGES).where("false"), **FILES).count() == 0
    assert packing.pack(docs(EDGES).where("doc_id is null"), **FILES).count() > 0


def test_powers():
    assert packing._powers(0) == [] and packing._powers(700) == [512, 128, 32, 16, 8, 4]
