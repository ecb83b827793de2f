import hashlib
import re

from pyspark.sql import functions as F

from llm.conftest import EDGES
from tierflow.llm import pii


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        x = int(c) * (1 + i % 2)
        total += x // 10 + x % 10
    return total % 10 == 0


def base(text):
    text, spans = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            spans.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m[0])) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return sorted(spans, key=lambda s: (s[1], pii.BASE_KINDS.index(s[0])))


HARD = [
    "a@b.com_x@y.com 1.2.3.4.5.6.7.8 4111 1111 1111 1111 x+1 (743) 555-3824. 300.1.1.1 000255.1.1.1",
    "1 " * 2000 + "a@b.c " * 600 + "1.1.1.1 " * 700, "9" * 20_000, "x@" * 3000, "a.b." * 3000 + "@",
    "+" + "1 " * 3000 + "x", "é😀 +44 20 7946 0958, 4111-1111-1111-1112 4111-1111-1111-1111", "@@a@b..c@d.e-",
    "+1+1 2345678901 +12345678901234567", "1.2.3.4@5.6.7.8", "00 4111111111111111 0",
]


def test_base_spans_equal_plain_search(docs):
    rows = [*EDGES, *enumerate(HARD, 100)]
    found = pii.find_personal_data(docs(rows)).collect()
    assert len(found) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t)
    for r in found:
        spans = base(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), r.doc_id
        counts = [sum(s[0] == k for s in spans) for k in pii.BASE_KINDS]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_running_sums(spark):
    data = [list(range(n)) for n in (1, 2, 255, 256, 257, 1000)]
    df = spark.createDataFrame([(x,) for x in data], "x array<int>")
    for r in df.select("x", pii._running(F.col("x")).alias("s")).collect():
        assert r.s == [sum(r.x[:i]) for i in range(len(r.x))]


def test_checksums(spark):
    rows = [("GB82 WEST 1234 5698 7654 32", True), ("GB82 WEST 1234 5698 7654 33", False),
            ("DE89370400440532013000", True)]
    df = spark.createDataFrame(rows, "m string, ok boolean")
    assert all(r.ok == r.found for r in df.select("ok", pii._iban(F.col("m")).alias("found")).collect())


def test_reliabilities_find_the_good_labeler(spark):
    """Two labelers that agree and one that guesses: the first two get the better estimates."""
    rows = []
    for i in range(400):
        true = i % 2
        rows.append(("card", [None, true, true, (i // 2) % 2, None, None]))
    found = pii.reliabilities(spark.createDataFrame([(k, v, [0]) for k, v in rows], "kind string, votes array<int>, features array<int>")).first()
    assert found.q.a[1] > 0.95 and found.q.b[1] < 0.05
    assert abs(found.q.a[3] - found.q.b[3]) < 0.2 and 0.4 < found.q.prior < 0.6


def test_method_adds_spans(docs):
    """Numbers that only look like accounts stay out; checked and announced ones come in."""
    rows = [(i, f"my account DE8937040044053201300{0} and tel 555-123-{4000 + i} ok") for i in range(30)]
    rows += [(100 + i, f"order {1000000 + i * 7919} was 12 of {20000000 + i}") for i in range(60)]
    found = {r.doc_id: r.spans for r in pii.find_personal_data(docs(rows)).collect()}
    assert all("iban:" in found[i] and "phone:" in found[i] for i in range(30))
    assert not any(found[100 + i] for i in range(60))


def test_empty(docs):
    assert pii.find_personal_data(docs(EDGES).where("false")).count() == 0
    only = pii.find_personal_data(docs([(1, "no numbers"), (2, None)])).collect()
    assert [r.spans for r in only] == ["", ""]


def test_numbers_side_by_side(docs):
    """Cards that stand next to each other are one run of digits, which no base rule passes."""
    one, two, three = "4111 1111 1111 1111", "5500 0000 0000 0004", "4012 8888 8888 1881"
    rows = [(i, f"card {one} {two} end") for i in range(20)]
    rows += [(50 + i, f"card {one}-{two} {three}") for i in range(20)] + [(99, f"pay {one} 12 now")]
    found = {r.doc_id: r for r in pii.find_personal_data(docs(rows)).collect()}
    assert all(r.n_card == 0 for r in found.values())
    assert found[0].spans == "card:5:24,card:25:44"
    assert found[50].spans == "card:5:24,card:25:44,card:45:64"
