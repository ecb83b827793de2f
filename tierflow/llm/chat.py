"""Quotation linking: conversations in reply order, without their quotes.

A message's lines are read with their quote levels (the number of ``>`` before them). Runs of
lines of one level are split at blank lines into passages; a passage's words, in lower case and
without punctuation, are hashed. Passages of level 0 index the messages that say them; quoted
passages are looked up there. The original of a quote is the first turn of its own conversation
that says it, if that is earlier, else the first message of another conversation that does. A quote
of several lines that isn't found whole is looked up by its lines, the first one first. Passages of
fewer than ``LEAST_WORDS`` words are linked within their own conversation only. A message replies to the turn that its outermost quote of its own conversation comes from (the first
such), or else to the turn before it.

Reply order is depth first. Messages that reply to the turn before form one thread with it; any
other reply opens a thread that hangs on the turn it replies to. ``thread`` is the thread's path:
for each thread from the first, the turn it hangs on (negative, as threads that hang on later
turns come first) and its first turn. Rows ordered by ``conv_id``, ``thread`` and ``turn`` are in
reply order; so no task needs a whole conversation.

Defined results: a null or empty text has no passage and an empty clean text, as has a message
that is all quotes; rows with one conversation and turn are one place in the order, and each gets
a row; a null turn is before all others; a null conversation id is one conversation; quotes of
nothing found link to null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, stored

_QUOTE = re.compile(r"^\s{0,3}((?:>\s?)+)")
_ATTRIBUTION = re.compile(r"(?:wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+")
#: Passages with fewer words say too little to be linked to another conversation.
LEAST_WORDS = 3


def quote_lines(text: str) -> list[tuple[int, str]]:
    """Level and content of each line."""
    out = []
    for line in text.split("\n"):
        match = _QUOTE.match(line)
        out.append((match.group(1).count(">"), line[match.end() :]) if match else (0, line))
    return out


def passages(text: str | None) -> list[tuple[int, str]]:
    """Level and text of each run of lines of one level, blank lines between runs left out."""
    out: list[tuple[int, list[str]]] = []
    open_level = None
    for level, line in quote_lines(text or ""):
        if not line.strip():
            open_level = None
            continue
        if level != open_level:
            out.append((level, []))
            open_level = level
        out[-1][1].append(line)
    return [(level, "\n".join(lines)) for level, lines in out]


def passage_hash(text: str) -> int | None:
    """Hash of the words as signed 64 bits, odd if they are few; None if there are none."""
    words = _WORD.findall(text.lower())
    if not words:
        return None
    digest = hashlib.blake2b(" ".join(words).encode(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True) & ~1 | (len(words) < LEAST_WORDS)


def own_hashes(found: list[tuple[int, str]]) -> list[int]:
    """Of the passages that a message says itself, and of each line of them: quotes are often cut."""
    own = [x for n, x in found if not n]
    own += [line for x in own if "\n" in x for line in x.split("\n")]
    return sorted({passage_hash(x) for x in own} - {None})


def quote_parts(found: list[tuple[int, str]]) -> list[dict[str, int]]:
    """What each quoted passage is looked up by: the whole (part 0), then its lines in order."""
    out = []
    for nth, (level, text) in enumerate(found):
        if level and passage_hash(text) is not None:
            parts = [text, *(text.split("\n") if "\n" in text else ())]
            hashes = [(i, passage_hash(x)) for i, x in enumerate(parts)]
            out += [{"level": level, "nth": nth, "part": i, "hash": h} for i, h in hashes if h is not None]
    return out


def clean_text(text: str | None) -> str:
    """The text without quoted lines and the lines that introduce them."""
    lines = quote_lines(text or "")
    kept = []
    for i, (level, line) in enumerate(lines):
        if level:
            continue
        following = next((x for x in lines[i + 1 :] if x[1].strip()), (0, ""))
        if following[0] and _ATTRIBUTION.search(line):
            continue
        kept.append(line)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(kept)).strip()


KEY = ("conv_id", "turn", "role", "text_hash")


def parsed(messages: DataFrame) -> DataFrame:
    """Messages with ``clean`` text, hashes ``said``, and ``quoted``, see ``quote_parts``."""

    def parse(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quote = pa.list_(
            pa.struct([*[(c, pa.int32()) for c in ("level", "nth", "part")], ("hash", pa.int64())])
        )
        for batch in batches(rows, 1 << 23):
            texts = batch.column("text").to_pylist()
            found = [passages(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in KEY],
                    pa.array([clean_text(t) for t in texts], pa.string()),
                    pa.array([own_hashes(x) for x in found], pa.list_(pa.int64())),
                    pa.array([quote_parts(x) for x in found], quote),
                ],
                names=[*KEY, "clean", "said", "quoted"],
            )

    kinds = [f"{c} {messages.schema[c].dataType.simpleString()}" for c in KEY]
    return messages.mapInArrow(
        parse,
        ", ".join(kinds)
        + ", clean string, said array<long>, quoted array<struct<level:int,nth:int,part:int,hash:long>>",
    )


def _same(left: DataFrame, right: DataFrame, *columns: str):
    """Null-safe equality of ``columns``, which are called ``<name>_r`` on the right."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[f"{c}_r"])
    return condition


def _renamed(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumnsRenamed({c: f"{c}_r" for c in columns})


def _links(rows: DataFrame) -> DataFrame:
    """By message that quotes: ``linked``, the first link's source, and the turn replied to."""
    quotes = rows.select(*KEY, F.explode("quoted").alias("quote")).select(*KEY, "quote.*")
    wanted = quotes.select("hash").distinct()
    said = rows.select("conv_id", "turn", F.explode("said").alias("hash"))
    said = said.join(wanted, "hash", "left_semi")
    firsts = stored(said.groupBy("conv_id", "hash").agg(F.min("turn").alias("own_turn")))
    place = F.struct("conv_id", F.col("own_turn").alias("turn"))
    # few words are linked within a conversation only
    many = firsts.where(F.col("hash") % 2 == 0)
    first = many.groupBy("hash").agg(F.min(place).alias("first"))
    # of conversations that aren't the first one's: for quotes in that one
    others = many.join(first, "hash").where(~F.col("conv_id").eqNullSafe(F.col("first.conv_id")))
    anywhere = first.join(others.groupBy("hash").agg(F.min(place).alias("second")), "hash", "left")
    here = _renamed(firsts, "conv_id", "hash")
    found = quotes.join(here, _same(quotes, here, "conv_id", "hash"), "left").join(
        anywhere, "hash", "left"
    )
    own = F.when(F.col("own_turn") < F.col("turn"), F.struct("conv_id", F.col("own_turn").alias("turn")))
    elsewhere = F.col("first.conv_id").eqNullSafe(F.col("conv_id"))
    other = F.when(F.col("first").isNotNull(), F.when(elsewhere, F.col("second")).otherwise(F.col("first")))
    ranked = found.withColumn("own", own).withColumn("source", F.coalesce("own", other))

    def least(c: str, *order: str):
        return F.min(F.when(F.col(c).isNotNull(), F.struct(*order, c)))

    passages = ranked.groupBy(*KEY, "level", "nth").agg(
        least("source", "part")["source"].alias("source"), least("own", "part")["own"].alias("own")
    )
    return (
        passages.groupBy(*KEY)
        .agg(
            F.count("source").alias("linked"),
            least("source", "level", "nth").alias("best"),
            least("own", "level", "nth").alias("reply"),
        )
        .select(
            *KEY,
            "linked",
            F.col("best.source.conv_id").alias("source_conv"),
            F.col("best.source.turn").alias("source_turn"),
            F.col("reply.own.turn").alias("quoted_turn"),
        )
    )


def _turns_before(rows: DataFrame, span: int = 4096) -> DataFrame:
    """Each conversation's different turns with the turn ``before``.

    Looked up within spans of turns, and between spans where a span begins, so that no task
    orders all turns of a long conversation.
    """
    turns = rows.select("conv_id", "turn").distinct().withColumn("span", F.floor(F.col("turn") / span))
    within = Window.partitionBy("conv_id", "span").orderBy("turn")
    ends = turns.groupBy("conv_id", "span").agg(F.max("turn").alias("end"))
    between = Window.partitionBy("conv_id").orderBy("span")
    ends = _renamed(
        ends.withColumn("end", F.lag("end").over(between)), "conv_id", "span"
    )
    turns = turns.withColumn("before", F.lag("turn").over(within))
    return turns.join(ends, _same(turns, ends, "conv_id", "span")).select(
        "conv_id", "turn", F.coalesce("before", "end").alias("before")
    )


def _places(joined: DataFrame) -> DataFrame:
    """By conversation and turn: what the turn ``hangs`` on if it opens a thread, and the ``start``

    of its thread, that is the last turn up to it that opens one.
    """
    opens = F.max(F.coalesce("opens", F.lit(False))).alias("opens")
    turns = joined.groupBy("conv_id", "turn").agg(
        opens, F.min(F.when(F.col("opens"), F.col("reply_turn"))).alias("hangs")
    )
    so_far = Window.partitionBy("conv_id").orderBy("turn")
    start = F.last(F.when(F.col("opens"), F.col("turn")), ignorenulls=True).over(so_far)
    return turns.withColumn("start", start)


def _threads(places: DataFrame) -> DataFrame:
    """``conv_id``, ``start`` and ``path`` of the threads that quotes open.

    Paths are made by doubling: in each round a thread's path so far is put behind that of the
    thread on top of it.
    """
    opened = places.where("opens").select("conv_id", "turn", "hangs")
    on = places.select(
        F.col("conv_id").alias("conv_id_r"), F.col("turn").alias("hangs_r"), F.col("start").alias("top")
    )
    paths = stored(
        opened.join(on, _same(opened, on, "conv_id", "hangs"), "left").select(
            "conv_id", F.col("turn").alias("start"), "top", F.array(-F.col("hangs"), "turn").alias("path")
        )
    )
    while not paths.where("top is not null").isEmpty():
        tops = paths.select(
            F.col("conv_id").alias("conv_id_r"), F.col("start").alias("top_r"),
            F.col("top").alias("next"), F.col("path").alias("upper"),
        )
        paths = stored(
            paths.join(tops, _same(paths, tops, "conv_id", "top"), "left").select(
                "conv_id",
                "start",
                F.col("next").alias("top"),
                F.when(F.col("upper").isNull(), F.col("path"))
                .otherwise(F.concat("upper", "path"))
                .alias("path"),
            )
        )
    return paths.select("conv_id", "start", "path")


def link_quotations(conversations: DataFrame) -> DataFrame:
    """One row for each message of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``).

    ``text`` is the clean text, ``quotes`` the number of quoted passages, ``linked`` of those that
    are found, ``source_conv`` and ``source_turn`` the message of the first link, ``reply_turn``
    the turn replied to (null for the first) and ``thread`` the path described above.
    """
    messages = conversations.select(
        "conv_id", "turn", "role", "text", F.xxhash64("text").alias("text_hash")
    )
    rows = stored(parsed(messages))
    links = _renamed(stored(_links(rows)), *KEY)
    before = _renamed(_turns_before(rows), "conv_id", "turn")
    joined = (
        rows.join(links, _same(rows, links, *KEY), "left")
        .drop(*links.columns[: len(KEY)])
        .join(before, _same(rows, before, "conv_id", "turn"))
        .select(
            "conv_id", "turn", "role", F.col("clean").alias("text"),
            F.size(F.array_distinct(F.transform("quoted", lambda q: q["nth"]))).cast("long").alias("quotes"),
            F.coalesce("linked", F.lit(0)).cast("long").alias("linked"),
            "source_conv", "source_turn",
            F.coalesce("quoted_turn", "before").alias("reply_turn"),
            (F.col("quoted_turn") < F.col("before")).alias("opens"),
        )
    )
    joined = stored(joined)
    places = stored(_places(joined))
    threads = _renamed(stored(_threads(places)), "conv_id", "start")
    turns = places.select("conv_id", "turn", "start")
    paths = turns.join(threads, _same(turns, threads, "conv_id", "start"), "left").select(
        F.col("conv_id").alias("conv_id_r"), F.col("turn").alias("turn_r"), "path"
    )
    return (
        joined.join(paths, _same(joined, paths, "conv_id", "turn"))
        .withColumn("thread", F.coalesce("path", F.array().cast("array<bigint>")))
        .drop("opens", "conv_id_r", "turn_r", "path")
    )
