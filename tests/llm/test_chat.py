import random
import re

from tierflow.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def test_parsing():
    assert chat.quote_lines("a\n> b\n>> c\n> > d") == [(0, "a"), (1, "b"), (2, "c"), (2, "d")]
    assert chat.passages("a\nb\n\nc\n> d\n> e\nf") == [(0, "a\nb"), (0, "c"), (1, "d\ne"), (0, "f")]
    assert chat.passages(None) == [] and chat.clean_text(None) == ""
    assert chat.clean_text("On Monday X wrote:\n> old\n\nnew") == "new"
    assert chat.clean_text("X wrote: nothing") == "X wrote: nothing"
    same = chat.passage_hash("Some, words HERE!")
    assert same == chat.passage_hash("some words\nhere") and not same & 1
    assert chat.passage_hash("two words") & 1 and chat.passage_hash("-- !") is None


ROWS = [
    (1, 0, "u", "Hello there my good friend.\n\nSecond passage of words here."),
    (1, 1, "a", "I answer you with words."),
    (1, 2, "u", "> Hello there my good friend.\n\nAnd this replies to the first message."),
    (1, 3, "a", "On Monday X wrote:\n>> Hello there my good friend.\n> And this replies to the first message.\n\nNested."),
    (1, 4, "u", "> I answer you with words.\nback to the answer"),
    (1, 5, "a", "> back to the answer\nright after"),
    (2, 0, "u", "> I answer you with WORDS!\ncross conversation quote"),
    (2, 1, "u", None), (2, 1, "u", ""), (None, None, None, "> nothing of this is found"),
    (3, 5, "u", "> said later on here"), (3, 6, "u", "said later on here"),
]


def test_links_and_order(spark):
    found = chat.link_quotations(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert len(found) == len(ROWS)
    by = {(r.conv_id, r.turn): r for r in found}
    assert {k: (r.reply_turn, r.source_conv, r.source_turn) for k, r in by.items() if k[0]} == {
        (1, 0): (None, None, None), (1, 1): (0, None, None), (1, 2): (0, 1, 0), (1, 3): (2, 1, 2),
        (1, 4): (1, 1, 1), (1, 5): (4, 1, 4), (2, 0): (None, 1, 1), (2, 1): (0, None, None),
        (3, 5): (None, None, None), (3, 6): (5, None, None),
    }
    order = sorted((r for r in found if r.conv_id == 1), key=lambda r: (r.thread, r.turn))
    assert [r.turn for r in order] == [0, 1, 4, 5, 2, 3]
    assert by[1, 3].text == "Nested." and by[1, 3].quotes == 2 and by[1, 3].linked == 2
    assert by[None, None].linked == 0 and by[None, None].quotes == 1


def test_reply_order_is_depth_first(spark):
    """Against a plain walk: each message after its parent, a parent's later branches first."""
    said = lambda i: f"message number {i} says something"
    replies = {4: 1, 6: 2, 7: 4, 9: 0, 12: 9, 13: 3}
    rows = [
        (1, i, "u", (f"> {said(replies[i])}\n" if i in replies else "") + said(i)) for i in range(15)
    ]
    parent = {i: replies.get(i, i - 1) for i in range(1, 15)}
    children = {}
    for child, p in parent.items():
        children.setdefault(p, []).append(child)
    walk, stack = [], [0]
    while stack:
        i = stack.pop()
        walk.append(i)
        # the next turn first, then the threads that quotes open, in order of turn
        nexts = sorted(children.get(i, []), key=lambda c: (c in replies, c))
        stack += reversed(nexts)
    found = chat.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.turn: r.reply_turn for r in found if r.turn} == parent
    assert [r.turn for r in sorted(found, key=lambda r: (r.thread, r.turn))] == walk


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 AS quotes", "'x' AS thread", "2 AS path")
    assert chat.link_quotations(df.where("false")).count() == 0
    assert chat.link_quotations(df).count() == len(ROWS)


def linked(spark, rows):
    found = chat.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()
    return {(r.conv_id, r.turn): (r.quotes, r.linked, r.source_conv, r.source_turn, r.reply_turn) for r in found}


def test_links_that_depend_on_no_order_of_ids(spark):
    """The first message that says it lies later in the quoting conversation; another has it too."""
    rows = [
        (1, 0, "u", "> these are the quoted words"), (1, 1, "u", "these are the quoted words"),
        (2, 4, "u", "these are the quoted words"), (3, 0, "u", "> these are the quoted words"),
    ]
    found = linked(spark, rows)
    assert found[1, 0][:4] == (1, 1, 2, 4) and found[3, 0][:4] == (1, 1, 1, 1)


def test_parts_of_passages_and_few_words(spark):
    three = "the first line of three\nthe second line of three\nthe third line of three"
    rows = [
        (1, 0, "u", three), (1, 1, "a", "Thank you"), (1, 2, "a", "something else said here"),
        (1, 3, "u", "> the first line of three\n> the second line of three\nyes"),
        (1, 4, "u", "> unknown words before it\n> the third line of three\nno"),
        (1, 5, "u", "> Thank you!\nwelcome"), (2, 0, "u", "> Thank you\nhere too"), (2, 1, "u", "> ---\nx"),
    ]
    found = linked(spark, rows)
    assert found[1, 3] == (1, 1, 1, 0, 0) and found[1, 4] == (1, 1, 1, 0, 0)
    assert found[1, 5] == (1, 1, 1, 1, 1)
    assert found[2, 0] == (1, 0, None, None, None) and found[2, 1][:2] == (0, 0)


def plain_links(rows):
    """Every quote compared with every passage and line of every message."""

    def words(text):
        return tuple(re.findall(r"[^\W_]+", text.lower()))

    def says(text, wanted):
        own = [x for n, x in chat.passages(text) if not n]
        return wanted in {words(x) for p in own for x in (p, *p.split("\n"))}

    out = {}
    for conv, turn, _, text in rows:
        sources, replies = [], []
        quotes = [(n, i, x) for i, (n, x) in enumerate(chat.passages(text)) if n and words(x)]
        for level, nth, passage in quotes:
            parts = [w for w in map(words, [passage, *(passage.split("\n") if "\n" in passage else [])]) if w]
            source = own = None
            for part in parts:
                inside = min((t for c, t, _, x in rows if c == conv and says(x, part)), default=None)
                inside = inside if inside is not None and inside < turn else None
                outside = min(((c, t) for c, t, _, x in rows if c != conv and says(x, part)), default=None)
                if own is None and inside is not None:
                    own = inside
                if source is None and inside is not None:
                    source = (conv, inside)
                if source is None and len(part) >= 3 and outside:
                    source = outside
            sources += [(level, nth, source)] if source else []
            replies += [(level, nth, own)] if own is not None else []
        before = max((t for c, t, _, _ in rows if c == conv and t < turn), default=None)
        link = min(sources)[2] if sources else (None, None)
        out[conv, turn] = (len(quotes), len(sources), *link, min(replies)[2] if replies else before)
    return out


def test_links_by_comparing_everything(spark):
    rng = random.Random(11)
    lines = ["yes", "thank you", "see below", *[f"line number {i} says this" for i in range(12)]]

    def message():
        parts = []
        for _ in range(rng.randrange(1, 4)):
            mark = rng.choice(["", "", "> ", ">> "])
            parts.append("\n".join(mark + rng.choice(lines) for _ in range(rng.randrange(1, 4))))
        return "\n\n".join(parts)

    rows = [(c, t, "u", message()) for c in range(12) for t in range(rng.randrange(1, 9))]
    assert linked(spark, rows) == plain_links(rows)
