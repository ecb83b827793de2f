"""Personal data by weak supervision, in DataFrame expressions only.

Base rules find e-mail addresses, IP addresses, payment cards and international phone numbers, and
those always stay. Looser expressions propose candidates. Labelers vote on each (1 for, 0 against,
null for no opinion): the strict expression, a checksum, the format, gazetteers, and words before
the span that speak for or against. Votes are counted by kind and pattern, and
expectation-maximisation over these few counts estimates each labeler's reliability without any
labels. The posterior of its pattern is a candidate's soft label; from those a naive Bayes span
classifier is trained on hashed features of the votes, the shape and the surroundings, and it
decides which candidates are added.

Defined results: a null or empty text has no spans; repeated rows are judged each, alike; without
candidates nothing is added; an empty table gives no rows; other columns pass by. Places are code
points, ends exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

#: In the order in which spans at one place are listed; the first four are the base rules.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "ssn", "iban")

# The base expressions, written so that no run of characters is tried from each of
# its places (possessive, and from a run's start or where the last match ended).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must hold for the expression to be worth trying.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
# Looser expressions for candidates, and what they need.
LOOSE = {
    "mail": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+"
        r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,24}+){1,4}+",
        r"@|\(at\)|\[at\]",
    ),
    # of numbers side by side, longer together than any card: the groups of four of the first
    "number": (
        r"(?<![A-Za-z0-9])(?:[0-9]{4}(?:[ -][0-9]{4}){3}(?=[ ().-]{1,2}[0-9](?:[ ().-]{0,2}[0-9]){4})"
        r"|[+(]?[0-9](?:[ ().-]{0,2}+[0-9]){6,24}+(?![A-Za-z0-9]))",
        r"[0-9][ ().-]{0,2}[0-9]",
    ),
    "account": (
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}",
    ),
}
# Gazetteers: common top-level domains, calling codes, and words before a span.
DOMAINS = "com|org|net|edu|gov|int|info|biz|io|de|fr|es|uk|us|eu|ca|au|it|nl|ch|at|be|pl|se|jp|cn|br|in|mx"
CALLING = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
WORDS_FOR = (
    "e-?mail|mail|contact|tel|phone|mobile|fax|call|card|visa|credit|account|iban|ssn|social"
    "|address|kontakt|telefon|karte|konto|courriel|correo|tarjeta|cuenta|carte|compte"
)
WORDS_AGAINST = "version|isbn|issn|doi|order|invoice|price|total|page|figure|[$€£#=]"
VOTERS = 6
#: Iterations of the estimate, and buckets of each feature of the classifier.
ROUNDS, BUCKETS = 20, 4096
FEATURES = 5


def _running(steps: Column, block: int = 256) -> Column:
    """Sums of the steps before each step, by blocks, so that no list is copied at each step."""

    def small(values: Column, start: Column) -> Column:
        empty = F.struct(start.alias("s"), F.array().cast("array<int>").alias("a"))
        return F.aggregate(
            values,
            empty,
            lambda acc, v: F.struct(
                (acc["s"] + v).alias("s"), F.array_append(acc["a"], acc["s"]).alias("a")
            ),
            lambda acc: acc["a"],
        )

    def blocks(values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))
        parts = F.transform(numbers, lambda k: F.slice(values, k * block + 1, F.lit(block)))

        def joined(x: Column) -> Column:
            sums = F.transform(x, lambda v: F.aggregate(v, F.lit(0), lambda a, b: a + b))
            return F.flatten(F.zip_with(x, small(sums, F.lit(0)), small))

        return let(parts, joined)

    return let(steps, blocks)


def matches(text: Column, pattern: str, needs: str) -> Column:
    """All matches: ``start``, ``end``, ``m`` and some characters ``before`` and ``after``."""
    kind = "array<struct<start:int,end:int,m:string,before:string,after:string>>"

    def located(found: Column) -> Column:
        def placed(parts: Column) -> Column:
            steps = F.zip_with(
                F.slice(parts, F.lit(1), F.size(found)),
                found,
                lambda a, b: F.length(a) + F.length(b),
            )
            return let(
                _running(steps),
                lambda s: F.transform(
                    found,
                    lambda m, i: F.struct(
                        (F.get(s, i) + F.length(F.get(parts, i))).alias("start"),
                        (F.get(s, i) + F.length(F.get(parts, i)) + F.length(m)).alias("end"),
                        m.alias("m"),
                        F.substring(F.get(parts, i), -40, 40).alias("before"),
                        F.substring(F.get(parts, i + 1), 1, 12).alias("after"),
                    ),
                ),
            )

        return F.when(
            F.size(found) > 0, let(F.split(text, pattern, -1), placed)
        ).otherwise(F.array().cast(kind))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(needs), let(found, located)).otherwise(F.array().cast(kind)).cast(kind)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """Whether the digits pass Luhn's check: from the right, every second one doubled."""

    def check(d: Column) -> Column:
        values = F.transform(
            F.sequence(F.lit(0), F.length(d) - 1),
            lambda i: F.substr(d, F.length(d) - i, F.lit(1)).cast("int") * (1 + i % 2),
        )
        total = F.aggregate(values, F.lit(0), lambda a, x: a + F.floor(x / 10).cast("int") + x % 10)
        return total % 10 == 0

    return let(_digits(m), check)


def _parts_at_most_255(m: Column) -> Column:
    def small(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+", "")
        return (F.length(short) < 3) | ((F.length(short) == 3) & (short <= "255"))

    return F.forall(F.split(m, r"\."), small)


def base_valid(kind: str, m: Column) -> Column:
    count = F.length(_digits(m))
    return {
        "email": F.lit(True),
        "ip": _parts_at_most_255(m),
        "card": F.when(count.between(14, 19), _luhn(m)).otherwise(False),
        "phone": count.between(10, 15),
    }[kind]


def _spans(found: Column, kind: str) -> Column:
    """``start``, ``rank`` of the kind, ``end``, ``kind``, which sorts as spans are listed."""
    return F.transform(
        found,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            x["end"].alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )


def _base(text: Column, kind: str) -> Column:
    found = matches(text, BASE[kind], NEEDS[kind])
    return _spans(F.filter(found, lambda x: base_valid(kind, x["m"])), kind)


def base_spans(text: Column) -> Column:
    return F.array_sort(F.concat(*[_base(text, kind) for kind in BASE_KINDS]))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, 0)


def _iban(m: Column) -> Column:
    """Whether the account's check digits are right: remainder of nine digits at a time."""
    plain = F.upper(F.regexp_replace(m, " ", ""))
    moved = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    codes = F.transform(
        F.split(moved, ""),
        lambda c: F.when(c.rlike("^[A-Z]$"), (F.ascii(c) - 55).cast("string")).otherwise(c),
    )
    return (
        F.aggregate(
            F.split(F.array_join(codes, ""), ""),
            F.lit(0),
            lambda a, d: F.when(d == "", a).otherwise((a * 10 + d.try_cast("int")) % 97),
        )
        == 1
    )


def _candidate(x: Column, group: str) -> Column:
    """Kind, votes and feature buckets of a candidate."""
    m, digits = x["m"], F.length(_digits(x["m"]))
    if group == "number":
        kind = (
            F.when(m.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"), "ip")
            .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
            .when(digits >= 14, "card")
            .otherwise("phone")
        )
    else:
        kind = F.lit({"mail": "email", "account": "iban"}[group])

    def judged(k: Column) -> Column:
        strict = reduce(
            lambda a, b: a | b,
            [(k == name) & m.rlike(f"^(?:{BASE[name]})$") for name in BASE_KINDS],
        )
        checked = (
            F.when(k == "card", F.when(digits.between(14, 19), _luhn(m)).otherwise(False))
            .when(k == "ip", _parts_at_most_255(m))
            .when(k == "iban", _iban(m))
        )
        shaped = _vote(
            ((k == "phone") & m.rlike(r"^[+(]|^[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}$"))
            | ((k == "card") & m.rlike(r"^[0-9]{4}([ -][0-9]{4}){2,3}|^[0-9]{14,19}$"))
            | (k == "ssn"),
            k.isin("phone", "card"),
        )
        listed = (
            F.when(k == "email", m.rlike(rf"(?i)(?:{DOMAINS})$"))
            .when(k == "phone", m.rlike(rf"^\+(?:{CALLING})"))
            .when(k == "card", m.rlike("^[3-6]"))
            .when(k == "ssn", ~m.rlike("^(?:000|666|9)"))
        )
        votes = F.array(
            F.when(strict, 1),
            checked.cast("int"),
            shaped,
            listed.cast("int"),
            F.when(F.lower(x["before"]).rlike(rf"\b(?:{WORDS_FOR})\b"), 1),
            F.when(F.lower(x["before"]).rlike(rf"(?:{WORDS_AGAINST}) ?$") | x["after"].rlike("^ ?[%€$]"), 0),
        )
        shape = F.regexp_replace(F.regexp_replace(m, "[0-9]", "9"), "[A-Za-z]+", "a")
        last_word = F.regexp_extract(F.lower(x["before"]), r"(\S+)\s*$", 1)
        edge = F.concat(F.substring(x["before"], -1, 1), F.lit("|"), F.substring(x["after"], 1, 1))
        texts = (
            F.array_join(F.transform(votes, lambda v: v.cast("string")), ",", "-"),
            F.substring(shape, 1, 24),
            F.when(last_word.rlike(f"^(?:{WORDS_FOR})"), "for").otherwise("other"),
            F.regexp_replace(F.regexp_replace(edge, "[0-9]", "9"), r"\p{L}", "a"),
            F.length(m).cast("string"),
        )
        buckets = F.array(
            *[
                (F.pmod(F.xxhash64(k, t), F.lit(BUCKETS)) + i * BUCKETS).cast("int")
                for i, t in enumerate(texts)
            ]
        )
        return F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            k.alias("kind"),
            votes.alias("votes"),
            buckets.alias("features"),
        )

    return let(kind, judged)


def _proposed(text: Column, group: str) -> Column:
    return F.transform(matches(text, *LOOSE[group]), lambda x: _candidate(x, group))


def candidates(text: Column) -> Column:
    return F.concat(*[_proposed(text, group) for group in LOOSE])


# Expectation-maximisation over the vote patterns of one kind: ``q`` are the parameters (prior,
# chance of a vote for true spans ``a`` and for others ``b``), ``p`` a pattern with its count.
_POSTERIOR = f"""1 / (1 + exp(-(ln(q.prior / (1 - q.prior)) + aggregate(sequence(0, {VOTERS - 1}), 0D,
  (s, j) -> s + CASE p.votes[j] WHEN 1 THEN ln(q.a[j] / q.b[j])
                                WHEN 0 THEN ln((1 - q.a[j]) / (1 - q.b[j])) ELSE 0D END))))"""
_WEIGHED = f"transform(patterns, p -> struct(p.votes AS votes, p.n AS n, {_POSTERIOR} AS y))"


def _total(of: str) -> str:
    return f"aggregate(e, 0D, (s, x) -> s + {of})"


_MAXIMISED = f"""transform(array({_WEIGHED}), e -> struct(
  ({_total("x.n * x.y")} + 1) / ({_total("x.n")} + 2) AS prior,
  transform(sequence(0, {VOTERS - 1}), j ->
    ({_total("IF(x.votes[j] = 1, x.n * x.y, 0D)")} + 4) /
    ({_total("IF(x.votes[j] IS NULL, 0D, x.n * x.y)")} + 5)) AS a,
  transform(sequence(0, {VOTERS - 1}), j ->
    ({_total("IF(x.votes[j] = 1, x.n * (1 - x.y), 0D)")} + 1) /
    ({_total("IF(x.votes[j] IS NULL, 0D, x.n * (1 - x.y))")} + 5)) AS b))[0]"""
_START = f"struct(0.5D AS prior, array_repeat(0.8D, {VOTERS}) AS a, array_repeat(0.2D, {VOTERS}) AS b)"


def reliabilities(found: DataFrame) -> DataFrame:
    """By ``kind``: ``patterns`` of votes with counts, and the estimate ``q`` after all rounds.

    Patterns are at most three to the power of the labelers, whatever the number of rows.
    """
    counted = found.groupBy("kind", "votes").agg(F.count("*").cast("double").alias("n"))
    return counted.groupBy("kind").agg(F.collect_list(F.struct("votes", "n")).alias("patterns")).select(
        "kind",
        "patterns",
        F.expr(f"aggregate(sequence(1, {ROUNDS}), {_START}, (q, r) -> {_MAXIMISED})").alias("q"),
    )


def classifier(found: DataFrame, estimates: DataFrame) -> DataFrame:
    """One row: ``weights``, the log-ratio of each feature bucket, and the prior's as the last."""
    soft = estimates.select("kind", F.explode(F.expr(_WEIGHED)).alias("x")).select(
        "kind", "x.votes", "x.y"
    )
    counted = (
        found.groupBy("kind", "votes", "features")
        .agg(F.count("*").alias("n"))
        .join(stored(soft), ["kind", "votes"])
        .selectExpr("features", "n * y AS yes", "n * (1 - y) AS no")
    )
    buckets = counted.select("yes", "no", F.explode("features").alias("bucket"))
    last = FEATURES * BUCKETS
    totals = buckets.where(f"bucket < {BUCKETS}").selectExpr("yes", "no", f"{last} AS bucket")
    ratio = "ln((coalesce(sum(yes), 0D) + 1) / (coalesce(sum(no), 0D) + 1))"
    sums = buckets.unionByName(totals).groupBy("bucket").agg(F.expr(ratio).alias("w"))
    every = found.sparkSession.range(last + 1).select(F.col("id").cast("int").alias("bucket"))
    return (
        every.join(sums, "bucket", "left")
        .select("bucket", F.coalesce("w", F.lit(None).cast("double")).alias("w"))
        .agg(F.array_sort(F.collect_list(F.struct("bucket", "w"))).alias("all"))
        .select(F.expr("transform(all, x -> x.w)").alias("weights"))
    )


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, ``base_sha256`` and ``spans``; ``docs`` has ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    first = stored(
        docs.select("doc_id", base_spans(text).alias("base"), candidates(text).alias("proposed"))
    )
    found = first.select(F.explode("proposed").alias("c")).select(
        "c.kind", "c.votes", "c.features"
    )
    weights = stored(classifier(found, stored(reliabilities(found))))
    prior = FEATURES * BUCKETS

    def accepted(c: Column) -> Column:
        # log-odds: the prior's and, for each feature seen, its ratio beyond the prior's
        odds = F.aggregate(
            c["features"],
            F.coalesce(F.get("weights", F.lit(prior)), F.lit(0.0)),
            lambda a, b: a
            + F.coalesce(F.get("weights", b) - F.get("weights", F.lit(prior)), F.lit(0.0)),
        )
        return odds > 0

    def free(c: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    rank = F.create_map(*[F.lit(x) for pair in zip(KINDS, range(len(KINDS))) for x in pair])
    added = F.transform(
        F.filter("proposed", lambda c: free(c) & accepted(c)),
        lambda c: F.struct(
            c["start"].alias("start"),
            F.element_at(rank, c["kind"]).alias("rank"),
            c["end"].alias("end"),
            c["kind"].alias("kind"),
        ),
    )
    counts = [
        F.expr(f"cast(size(filter(base, b -> b.kind = '{k}')) as long) as n_{k}")
        for k in BASE_KINDS
    ]
    return first.withColumn("weights", weights.scalar()).select(
        "doc_id",
        *counts,
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", added))).alias("spans"),
    )
