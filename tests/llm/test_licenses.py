import random
import re

import pytest
from re import _parser as parser

from conftest import bag
from llm.conftest import EDGES
from tierflow.llm import licenses
from tierflow.llm.licenses import BASE, Scanner, license_labels, license_rules, scan_licenses

RULES = license_rules()
SCANNER = Scanner(RULES)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_base(text):
    """(label, start) of every base phrase, word by word."""
    words = plain_words(text)
    return [
        (label, i)
        for i in range(len(words))
        for label, phrase in BASE
        if words[i : i + len(phrase.split())] == phrase.split()
    ]


def plain_labels(text):
    """Labels of matches that no better match contains: all pairs, all rules, no keywords."""
    stream = f" {' '.join(plain_words(text))} "
    kinds = list(licenses.KINDS)
    found = [
        (m.start(), m.end(), (kinds.index(r.kind), m.start() - m.end(), i), r)
        for i, r in enumerate(RULES)
        for m in re.finditer(rf"(?<= )(?:{r.pattern})(?= )", stream)
    ]
    kept = {
        r.label
        for a, b, rank, r in found
        if r.base or not any(c <= a and b <= d and other < rank for c, d, other, _ in found)
    }
    return sorted(kept)


SAMPLES = [
    ("This work is licensed under the GNU General Public License, version 3.", ["gpl", "gpl-3.0"]),
    ("Licensed under CC BY-NC 4.0.", ["cc-by", "cc-by-nc-4.0"]),
    ("Released under the MIT License.", ["mit"]),
    ("Licensed under the Apache License, Version 2.0.", ["apache", "apache-2.0"]),
    ("SPDX-License-Identifier: GPL-2.0-or-later", ["gpl-2.0-or-later"]),
    ("spdx-license-identifier: BSD-3-Clause", ["bsd-3-clause"]),
    ("GNU Lesser General Public License v2.1", ["lgpl-2.1"]),
    ("the mit licence and the MIT\nlicense", ["mit"]),
    ("https://creativecommons.org/licenses/by-sa/4.0/", ["cc-by-sa-4.0"]),
    ("Creative Commons Attribution-ShareAlike 3.0 Unported", ["cc-by-sa"]),
    (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\")",
        ["mit"],
    ),
    ("a license to drive, by the way; the mitlicense, GPLish apaches", []),
    ("gnu general public licenses are not the phrase", []),
]


@pytest.mark.parametrize("text, labels", SAMPLES)
def test_labels(text, labels):
    _, found = SCANNER.scan(text)
    assert sorted({d["label"] for d in found if d["kept"] or d["base"]}) == labels
    assert plain_labels(text) == labels


def test_there_are_hundreds_of_rules_none_of_which_reaches_too_far():
    assert len(RULES) > 300
    for rule in RULES:
        assert parser.parse(rule.pattern).getwidth()[1] + len(rule.keyword) < licenses.REACH, rule
        assert rule.keyword == " ".join(plain_words(rule.keyword)), rule


def text_of(rng, n):
    """Words of rule names, of their patterns' words and others, so that rules overlap."""
    names = [w for _, keyword, name, *_ in licenses.FAMILIES for w in (keyword, *WORD.findall(name))]
    names += [k for _, k, _ in licenses.NOTICES] + [p for _, p in BASE]
    names += ["version 2.0", "or later", "licensed under the", "SPDX-License-Identifier:", "3", "0", "ünder"]
    return rng.choice([" ", ", "]).join(rng.choice(names) for _ in range(n))


def test_keywords_lose_no_match_and_the_sweep_is_the_definition():
    rng = random.Random(5)
    for n in [5, 20, 60, 400]:
        for _ in range(12):
            text = text_of(rng, n)
            stream = f" {' '.join(plain_words(text)).encode().decode('latin-1')} "
            assert SCANNER.detections(stream) == SCANNER.detections(stream, everywhere=True)
            words, found = SCANNER.scan(text)
            assert words == len(plain_words(text))
            assert sorted({d["label"] for d in found if d["kept"] or d["base"]}) == plain_labels(text)


def test_every_text_by_plain_search(spark, docs):
    rng = random.Random(6)
    texts = [text_of(rng, n) for n in (3, 10, 50, 300)] + [t for t, _ in SAMPLES]
    rows = [*EDGES, *[(100 + i, t) for i, t in enumerate(texts)]]
    expected = []
    for doc_id, text in rows:
        places = plain_base(text)
        starts = [i for _, i in places]
        expected.append(
            (doc_id, len(plain_words(text)), len(places), min(starts, default=None),
             max(starts, default=None), ",".join(sorted({k for k, _ in places})),
             ",".join(plain_labels(text)))
        )
    result = license_labels(scan_licenses(docs(rows)))
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
    got = [tuple(r) for r in result.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in result.collect())


def test_empty_table(docs):
    result = license_labels(scan_licenses(docs([]).where("false")))
    assert result.count() == 0


def test_the_score_grows_with_independent_signs(spark, docs):
    rows = [(1, "mit license"), (2, "mit license. SPDX-License-Identifier: MIT"), (3, "mit license, mit license")]
    score = {r.doc_id: r.score for r in license_labels(scan_licenses(docs(rows))).collect()}
    assert score[3] == score[1] < score[2] < 1
    assert bag(license_labels(scan_licenses(docs(rows))))  # the same input can be scanned again


def test_a_long_text_is_read_to_its_end():
    text = "word " * 200_000 + "MIT License " + "mit license " * 2000
    words, found = SCANNER.scan(text)
    base = [d for d in found if d["base"]]
    assert words == 200_000 + 4002 and len(base) == 2001
    assert base[0]["first_word"] == 200_000 and base[-1]["end_word"] == words
