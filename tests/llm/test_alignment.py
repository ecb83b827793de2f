import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm.conftest import EDGES
from tierflow.llm import alignment
from tierflow.llm.alignment import Tokenizers, align

FILES = {
    "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
    "pattern": public_tokenizers.PATTERN,
    "model": public_tokenizers.path("piece_bpe_32k.model"),
}
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """The definition, token by token, from the other public form of A's vocabulary."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES["model"])
    # how the byte-level vocabulary spells bytes: visible ones by themselves, the others from 256 on
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in visible]
    spelled = {chr(x): x for x in visible} | {chr(256 + i): x for i, x in enumerate(hidden)}
    words = {i: t for t, i in a.get_vocab().items()}

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        whole = " " + text
        ids_a = a.encode(whole, add_special_tokens=False).ids
        side_a = [(i, bytes(spelled[c] for c in words[i])) for i in ids_a]
        side_b = [(i, bytes_b(i)) for i in b.encode(text)]
        raw = whole.encode()
        if any(b"".join(x for _, x in side) != raw for side in (side_a, side_b)):
            return [], []
        return side_a, side_b

    def places(side):
        at, out = 0, []
        for i, raw in side:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    def all_rows(rows):
        found, counts = [], Counter()
        for doc_id, text in rows:
            a_at, b_at = (places(x) for x in tokens(text))
            links, start = [], 0
            for i, s, e in a_at:
                while start < len(b_at) and b_at[start][2] <= s:
                    start += 1
                k = start
                while k < len(b_at) and b_at[k][1] < e:
                    links.append((i, b_at[k][0]))
                    k += 1
            ends = np.array(sorted({e for *_, e in a_at} & {e for *_, e in b_at}))
            group_a, group_b = defaultdict(list), defaultdict(list)
            for side, out in ((a_at, group_a), (b_at, group_b)):
                for i, _, e in side:
                    out[int(np.searchsorted(ends, e))].append(str(i))
            text = ";".join(f"{','.join(group_a[k])}|{','.join(group_b[k])}" for k in range(len(ends)))
            counts.update(set(links))
            found.append((doc_id, a_at, b_at, ends, links, text))
        best = defaultdict(int)
        for (i, _), n in counts.items():
            best[i] = max(best[i], n)
        return [
            (doc_id, len(a_at), len(b_at), len(ends), len(links),
             sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(text.encode()).hexdigest() if text else "")
            for doc_id, a_at, b_at, ends, links, text in found
        ]

    return all_rows


def compare(frame, expected):
    got = [tuple(r) for r in frame.select(*COLUMNS).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


ODD = [
    "<|endoftext|> is plain text, and so are <s> and </s> and <0x41>", "a  b   c\n\n d\t\te ", "  leading",
    "▁ changes its bytes", "aab aaab aaaab", "naïve café — “quoted” …", "日本語のテキスト", "😀😀 👩‍👩‍👧", "é decomposed",
    "\x00 null byte", "ｆｕｌｌ　ｗｉｄｔｈ", "x" * 700, "the the the", "12345 67890", "\r\n", "�", " ",
]


def test_by_plain_search(docs, plain):
    rows = [*EDGES, *[(100 + i, t) for i, t in enumerate(ODD)]]
    compare(align(docs(rows).repartition(3), **FILES), plain(rows))


@pytest.mark.parametrize("size", [200, 1 << 20])
def test_random_texts_in_small_and_large_chunks(spark, docs, plain, monkeypatch, size):
    monkeypatch.setattr(alignment, "CHUNK", size)
    rng = random.Random(size)
    words = ["the", "reading", "unhappily", "straße", "über", "ñandú", "日本", "😀", "xyzzy", "--", "3.14", "ing"]
    rows = [
        (i % 37, "".join(rng.choice(words) + rng.choice([" ", " ", "", "\n", "  "]) for _ in range(rng.randrange(60))))
        for i in range(300)
    ]
    compare(align(docs(rows).repartition(5), **FILES), plain(rows))


def test_given_documents(spark, plain):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    compare(align(table, **FILES), plain([tuple(r) for r in table.collect()]))


def test_empty_table_and_other_ids(spark, docs):
    assert align(docs([]).where("false"), **FILES).count() == 0
    named = docs([(1, "some text")]).selectExpr("'a' AS doc_id", "text")
    assert align(named, **FILES).first().doc_id == "a"


def test_identity_is_the_same_bytes():
    tools = Tokenizers(**FILES)
    place = np.flatnonzero(tools.identity >= 0)
    assert len(place) > 10_000
    assert all(tools.bytes_a[i] == tools.bytes_b[tools.identity[i]] for i in place)


def test_chunks_are_few_in_a_row_group(docs, monkeypatch, tmp_path):
    """Readers and writers hold a row group whole; it ends by its size, not by 100 chunks."""
    import glob

    import pyarrow.parquet as pq

    from tierflow.llm import common

    monkeypatch.setattr(common, "shared_root", lambda spark: str(tmp_path))
    monkeypatch.setitem(common._LARGE_ROWS, "parquet.block.size", "20000")
    monkeypatch.setattr(alignment, "CHUNK", 2000)
    rows = [(i, " ".join(f"w{i * k % 9973}" for k in range(200))) for i in range(60)]
    chunks = alignment.aligned_chunks(docs(rows).repartition(1), **FILES)
    assert chunks.where("chunk IS NOT NULL").count() > 20
    (file,) = glob.glob(f"{tmp_path}/*/*.parquet")
    assert pq.ParquetFile(file).metadata.num_row_groups > 3


def test_answers_of_a_chunk_are_sorted():
    import pyarrow as pa

    pairs = pa.table({"chunk": [7, 7, 7], "pair": [30, 10, 20], "c": [3, 1, 2]})
    assert alignment.told(pairs).to_pylist() == [{"chunk": 7, "known": [10, 20, 30], "totals": [1, 2, 3]}]


def test_small_batches_make_one_chunk():
    import pyarrow as pa

    from tierflow.llm.common import merged

    parts = [pa.record_batch({"text": ["x" * 100] * n}) for n in (1, 1, 30, 2, 1)]
    found = list(merged(parts, 1000))
    assert sum((b.column("text").to_pylist() for b in found), []) == ["x" * 100] * 35
    assert len(found) < 8 and max(b.num_rows for b in found) < 11
