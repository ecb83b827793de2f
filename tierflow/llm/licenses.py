"""License scans: ordered signature rules behind a keyword prefilter, overlaps resolved by priority.

Every text becomes a stream of lower-case words between single spaces. An Aho-Corasick automaton
reads the stream once for the rules' keywords; a rule's expression is tried only in the
neighbourhood of its keyword. Each rule belongs to a kind, and kinds have an order: identifiers
before notices, addresses, grants and names. A detection that lies within one of a better rule
(a better kind; within a kind the longer detection, then the rule written first) is suppressed.

``FAMILIES`` and ``NOTICES`` are written by hand; each family gives one rule for every kind it has
a pattern for, some hundreds in all. Four rules are *base*: their detections count whether they are
suppressed or not.

Defined results: a null or empty text has no words and no detections; repeated rows are scanned
each; an empty table gives no rows; long texts are read whole; ties of rules go to the one written
first; other columns of the input are not looked at. Word places count from 0, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches

# Kinds in order of priority, with how much a detection of each says.
KINDS = {"tag": 0.95, "notice": 0.9, "address": 0.85, "grant": 0.9, "name": 0.7}

#: Characters of the word stream that a detection may have, at most.
REACH = 512

_V1, _V2, _V3 = (rf"(?: (?:version|ver|v))? ?v?{n}(?: 0)?" for n in (1, 2, 3))
_V11, _V21 = (rf"(?: (?:version|ver|v))? ?v?{a} {b}" for a, b in ((1, 1), (2, 1)))
_LATER = r"(?: or(?: at your option)? (?:any )?(?:later|newer)(?: version)?| ?\+)"
_ANY_CC = r"(?: (?:\d \d|international|unported|generic|license|licence|public|deed)){0,6}"

# Label, words that the rule's name must hold (its keyword), name, identifier after
# an SPDX tag, words of an address. A missing part is None.
FAMILIES: tuple[tuple[str, str, str, str | None, str | None], ...] = (
    ("gpl-1.0", "general public license", rf"(?:gnu )?general public license(?: gpl)?{_V1}", "gpl 1 0(?: only)?", "gnu org licenses (?:old licenses )?gpl 1 0"),
    ("gpl-2.0-or-later", "general public license", rf"(?:gnu )?general public license(?: gpl)?{_V2}{_LATER}", "gpl 2 0 or later", None),
    ("gpl-2.0", "general public license", rf"(?:gnu )?general public license(?: gpl)?{_V2}(?! or| 1)", "gpl 2 0(?: only)?(?! or later)", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3.0-or-later", "general public license", rf"(?:gnu )?general public license(?: gpl)?{_V3}{_LATER}", "gpl 3 0 or later", None),
    ("gpl-3.0", "general public license", rf"(?:gnu )?general public license(?: gpl)?{_V3}(?! or)", "gpl 3 0(?: only)?(?! or later)", "gnu org licenses gpl 3 0"),
    ("gpl-2.0", "gplv2", "gplv2(?: 0)?", "gplv2", None),
    ("gpl-3.0", "gplv3", "gplv3(?: 0)?", "gplv3", None),
    ("gpl-2.0", "gpl", "gpl (?:version |v )?v?2(?: 0)?(?: only)?", None, None),
    ("gpl-3.0", "gpl", "gpl (?:version |v )?v?3(?: 0)?(?: only)?", None, "gnu org licenses gpl(?: html| txt)?"),
    ("gpl", "general public licence", "gnu general public licence", None, None),
    ("gpl", "gnu gpl", "gnu gpl", "gpl", None),
    ("lgpl-2.0", "library general public license", rf"(?:gnu )?library general public license(?: lgpl)?{_V2}", "lgpl 2 0(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 0"),
    ("lgpl-2.1", "lesser general public license", rf"(?:gnu )?lesser general public license(?: lgpl)?{_V21}(?:{_LATER})?", "lgpl 2 1(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", "lesser general public license", rf"(?:gnu )?lesser general public license(?: lgpl)?{_V3}(?:{_LATER})?", "lgpl 3 0(?: only| or later)?", "gnu org licenses lgpl 3 0"),
    ("lgpl", "lesser general public license", "(?:gnu )?lesser general public license", "lgpl", "gnu org licenses lgpl(?: html| txt)?"),
    ("lgpl-2.1", "lgpl", "lgpl (?:version |v )?v?2 1", None, None),
    ("lgpl-3.0", "lgpl", "lgpl (?:version |v )?v?3(?: 0)?", None, None),
    ("agpl-3.0", "affero general public license", rf"(?:gnu )?affero general public license(?: agpl)?{_V3}(?:{_LATER})?", "agpl 3 0(?: only| or later)?", "gnu org licenses agpl 3 0"),
    ("agpl", "affero general public license", "(?:gnu )?affero general public license", "agpl", "gnu org licenses agpl(?: html| txt)?"),
    ("agpl-3.0", "agplv3", "agplv3(?: 0)?", "agplv3", None),
    ("gfdl-1.3", "free documentation license", rf"(?:gnu )?free documentation license(?: version)? ?v?1 3(?:{_LATER})?", "gfdl 1 3(?: only| or later)?", "gnu org licenses fdl 1 3"),
    ("gfdl", "free documentation license", "(?:gnu )?free documentation license", "gfdl", "gnu org (?:licenses|copyleft) fdl(?: html| txt)?"),
    ("apache-1.0", "apache", "apache (?:software )?license(?: version)? 1 0", "apache 1 0", "apache org licenses license 1 0"),
    ("apache-1.1", "apache", "apache (?:software )?license(?: version)? 1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("apache-2.0", "apache license", rf"apache license{_V2}", "apache 2 0", "apache org licenses license 2 0(?: html| txt)?"),
    ("apache-2.0", "apache software license", rf"apache software license{_V2}", None, None),
    ("apache-2.0", "apache 2 0", "apache 2 0(?: license| licence)?", None, None),
    ("apache", "apache licence", "apache licence", "apache", None),
    ("apache", "apache software license", "apache software license", None, None),
    ("mit", "mit licence", "mit licence", "mit", "opensource org licenses mit(?: license)?(?: php| html)?"),
    ("mit", "expat", "expat licen[sc]e", "expat", None),
    ("mit-0", "mit no attribution", "mit no attribution(?: license)?", "mit 0", None),
    ("x11", "x11 license", "(?:mit )?x11 license", "x11", None),
    ("bsd-4-clause", "bsd license", "(?:4 clause|four clause|original) bsd license", "bsd 4 clause(?: uc)?", None),
    ("bsd-3-clause", "bsd license", "(?:3 clause|three clause|new|revised|modified) bsd license", "bsd 3 clause(?: clear| new| attribution)?", "opensource org licenses bsd 3 clause"),
    ("bsd-2-clause", "bsd license", "(?:2 clause|two clause|simplified|freebsd) bsd license", "bsd 2 clause(?: patent| freebsd| views)?", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "bsd 3 clause", "bsd 3 clause(?: license| licence)?", None, None),
    ("bsd-2-clause", "bsd 2 clause", "bsd 2 clause(?: license| licence)?", None, None),
    ("0bsd", "zero clause bsd", "(?:bsd )?zero clause bsd(?: license)?", "0bsd", None),
    ("bsd", "bsd", "bsd licen[sc]e", "bsd", "opensource org licenses bsd license(?: php| html)?"),
    ("isc", "isc", "isc licen[sc]e", "isc", "opensource org licenses isc(?: license)?"),
    ("mpl-1.1", "mozilla public license", rf"mozilla public license(?: mpl)?{_V11}", "mpl 1 1", "mozilla org mpl mpl 1 1"),
    ("mpl-2.0", "mozilla public license", rf"mozilla public license(?: mpl)?{_V2}", "mpl 2 0(?: no copyleft exception)?", "mozilla org (?:en us )?mpl 2 0"),
    ("mpl", "mozilla public license", "mozilla public license", "mpl", "mozilla org (?:en us )?mpl"),
    ("mpl-2.0", "mpl 2 0", "mpl 2 0", None, None),
    ("epl-1.0", "eclipse public license", rf"eclipse public license(?: epl)?{_V1}", "epl 1 0", "eclipse org legal epl v10(?: html)?"),
    ("epl-2.0", "eclipse public license", rf"eclipse public license(?: epl)?{_V2}", "epl 2 0", "eclipse org legal epl (?:v20|2 0)(?: html)?"),
    ("epl", "eclipse public license", "eclipse public license", "epl", None),
    ("cddl-1.0", "common development and distribution license", rf"common development and distribution license(?: cddl)?{_V1}", "cddl 1 0", "opensource org licenses cddl 1 0"),
    ("cddl-1.1", "common development and distribution license", rf"common development and distribution license(?: cddl)?{_V11}", "cddl 1 1", None),
    ("cddl", "common development and distribution license", "common development and distribution license", "cddl", None),
    ("cpl-1.0", "common public license", rf"common public license(?:{_V1})?", "cpl 1 0", "opensource org licenses cpl 1 0"),
    ("eupl-1.2", "european union public licence", "european union public licence(?: eupl)?(?: version| v)? ?v?1 2", "eupl 1 2", None),
    ("eupl", "european union public licence", "european union public licence", "eupl", "joinup ec europa eu software page eupl"),
    ("artistic-1.0", "artistic license", rf"artistic license{_V1}", "artistic 1 0(?: perl| cl8)?", "opensource org licenses artistic license 1 0"),
    ("artistic-2.0", "artistic license", rf"artistic license{_V2}", "artistic 2 0", "opensource org licenses artistic license 2 0"),
    ("artistic", "artistic license", "artistic license", "artistic", "perlfoundation org artistic license"),
    ("bsl-1.0", "boost software license", rf"boost software license(?:{_V1})?", "bsl 1 0", "boost org license 1 0(?: txt)?"),
    ("busl-1.1", "business source license", "business source license(?: 1 1)?", "busl 1 1", "mariadb com bsl11"),
    ("sspl-1.0", "server side public license", rf"server side public license(?:{_V1})?", "sspl 1 0", None),
    ("elastic-2.0", "elastic license", rf"elastic license(?:{_V2})?", "elastic 2 0", "elastic co licensing elastic license"),
    ("zlib", "zlib", "(?:the )?zlib(?: libpng)? license", "zlib", "opensource org licenses zlib(?: license)?(?: php)?"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl", "wtfpl net"),
    ("openssl", "openssl license", "openssl license", "openssl", None),
    ("postgresql", "postgresql license", "postgresql license", "postgresql", "opensource org licenses postgresql"),
    ("psf-2.0", "python software foundation license", "python software foundation license(?: version 2)?", "(?:psf|python) 2 0", "docs python org 3 license(?: html)?"),
    ("php-3.01", "php license", "php license(?: version)?(?: 3 0?1)?", "php 3 0?1", "php net license 3 01(?: txt)?"),
    ("ofl-1.1", "sil open font license", rf"sil open font license(?:{_V11})?", "ofl 1 1(?: rfn| no rfn)?", "scripts sil org ofl"),
    ("ms-pl", "microsoft public license", "microsoft public license(?: ms pl)?", "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft reciprocal license", "microsoft reciprocal license(?: ms rl)?", "ms rl", "opensource org licenses ms rl"),
    ("odbl-1.0", "open database license", "(?:odc )?open database license(?: odbl)?(?: v?1 0)?", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("odc-by-1.0", "open data commons attribution license", "open data commons attribution license(?: v?1 0)?", "odc by 1 0", "opendatacommons org licenses by"),
    ("pddl-1.0", "public domain dedication and license", "(?:open data commons )?public domain dedication and license", "pddl 1 0", "opendatacommons org licenses pddl"),
    ("ogl-uk-3.0", "open government licence", "open government licence(?: v?3 0)?", "ogl uk 3 0", "nationalarchives gov uk doc open government licence"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero 1 0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd", "cc by nc nd(?: 4 0)", "cc by nc nd 4 0", "creativecommons org licenses by nc nd 4 0"),
    ("cc-by-nc-nd-3.0", "cc by nc nd", "cc by nc nd(?: 3 0)", "cc by nc nd 3 0", "creativecommons org licenses by nc nd 3 0"),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd", None, "creativecommons org licenses by nc nd"),
    ("cc-by-nc-sa-4.0", "cc by nc sa", "cc by nc sa(?: 4 0)", "cc by nc sa 4 0", "creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-sa-3.0", "cc by nc sa", "cc by nc sa(?: 3 0)", "cc by nc sa 3 0", "creativecommons org licenses by nc sa 3 0"),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa", None, "creativecommons org licenses by nc sa"),
    ("cc-by-nc-4.0", "cc by nc", "cc by nc(?: 4 0)", "cc by nc 4 0", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nc-3.0", "cc by nc", "cc by nc(?: 3 0)", "cc by nc 3 0", "creativecommons org licenses by nc 3 0"),
    ("cc-by-nc", "cc by nc", "cc by nc(?! nd| sa)", None, "creativecommons org licenses by nc(?! nd| sa)"),
    ("cc-by-nd-4.0", "cc by nd", "cc by nd(?: 4 0)", "cc by nd 4 0", "creativecommons org licenses by nd 4 0"),
    ("cc-by-nd", "cc by nd", "cc by nd", None, "creativecommons org licenses by nd"),
    ("cc-by-sa-4.0", "cc by sa", "cc by sa(?: 4 0)", "cc by sa 4 0", "creativecommons org licenses by sa 4 0"),
    ("cc-by-sa-3.0", "cc by sa", "cc by sa(?: 3 0)", "cc by sa 3 0", "creativecommons org licenses by sa 3 0"),
    ("cc-by-sa", "cc by sa", "cc by sa", None, "creativecommons org licenses by sa"),
    ("cc-by-4.0", "cc by", "cc by(?: 4 0)", "cc by 4 0", "creativecommons org licenses by 4 0"),
    ("cc-by-3.0", "cc by", "cc by(?: 3 0)", "cc by 3 0", "creativecommons org licenses by 3 0"),
    ("cc-by-nc-nd", "creative commons attribution", rf"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?{_ANY_CC}", None, None),
    ("cc-by-nc-sa", "creative commons attribution", rf"creative commons attribution non ?commercial share ?alike{_ANY_CC}", None, None),
    ("cc-by-nc", "creative commons attribution", rf"creative commons attribution non ?commercial(?! no| share){_ANY_CC}", None, None),
    ("cc-by-nd", "creative commons attribution", rf"creative commons attribution no ?deriv(?:ative)?s?{_ANY_CC}", None, None),
    ("cc-by-sa", "creative commons attribution", rf"creative commons attribution share ?alike{_ANY_CC}", None, None),
    ("cc-by", "creative commons attribution", rf"creative commons attribution(?! non| no| share){_ANY_CC}", None, None),
)

# Label, keyword and expression of sentences that licenses and their headers have.
NOTICES: tuple[tuple[str, str, str], ...] = (
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("isc", "permission to use copy modify and", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("0bsd", "permission to use copy modify and", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse or promote products derived from this software", "neither the name of(?: [^ ]{1,20}){1,12} may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "all advertising materials mentioning features", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-2.0", "except in compliance with the license", "you may not use this (?:file|work|software) except in compliance with the license"),
    ("gpl-2.0-or-later", "redistribute it and or modify", f"redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2(?: of the license)?{_LATER}"),
    ("gpl-3.0-or-later", "redistribute it and or modify", f"redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3(?: of the license)?{_LATER}"),
    ("gpl", "redistribute it and or modify", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute it and or modify", "redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "redistribute it and or modify", "redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gfdl", "copy distribute and or modify this document", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2.0", "source code form is subject to the terms", f"this source code form is subject to the terms of the mozilla public license(?: v|{_V2})"),
    ("mpl-1.1", "contents of this file are subject to the mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-1.0", "accompanying materials are made available", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", "accompanying materials are made available", "this program and the accompanying materials are made available under the terms of the eclipse public license(?: v)? ?2 0"),
    ("zlib", "be held liable for any damages arising from the use", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("bsl-1.0", "distributed under the boost software license", "distributed under the boost software license version 1 0"),
    ("unlicense", "free and unencumbered software released", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "do what the fuck you want to public license", "do what the fuck you want to public license"),
    ("ofl-1.1", "this font software is licensed", "this font software is licensed under the sil open font license version 1 1"),
    ("python-2.0", "psf hereby grants licensee", "psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("cc0-1.0", "to the extent possible under law", "to the extent possible under law(?: [^ ]{1,20}){1,8} waived all copyright and related or neighboring rights"),
    ("public-domain", "public domain", "(?:released|dedicated|placed|donated) (?:in|into|to) the public domain"),
    ("proprietary", "all rights reserved", "copyright(?: [^ ]{1,20}){1,8} all rights reserved"),
)

# Phrases whose every place counts, with their labels.
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
_GRANT = (
    "(?:licensed|released|distributed|available|published|provided|covered|redistributed) "
    "(?:under|by|with) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
)


@dataclass(frozen=True)
class Rule:
    """A signature: tried where its keyword stands, named by its label, ranked by its kind."""

    label: str
    kind: str
    keyword: str
    pattern: str
    base: bool = False


def license_rules() -> list[Rule]:
    """All rules, in the order that decides between equals."""
    rules = [Rule(label, "notice", keyword, pattern) for label, keyword, pattern in NOTICES]
    for label, keyword, name, identifier, address in FAMILIES:
        if identifier:
            rules.append(
                Rule(label, "tag", "spdx license identifier", f"spdx license identifier {identifier}")
            )
        if address:
            # an address holds the words of its site, up to the first choice in the expression
            site = re.split(r"[(\[?\\]", address)[0].rstrip()
            rules.append(Rule(label, "address", site, address))
        rules.append(Rule(label, "grant", keyword, f"{_GRANT}{name}"))
        rules.append(Rule(label, "name", keyword, name))
    for label, phrase in BASE:
        rules.append(Rule(label, "grant", phrase, f"{_GRANT}{phrase}"))
        rules.append(Rule(label, "name", phrase, phrase, base=True))
    return rules


# Bytes of the word stream: A-Z as a-z, other ASCII than letters and digits as spaces.
_STREAM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def words_in(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_STREAM).split()


@dataclass(frozen=True)
class Detection:
    rule: int
    first: int  # places in the stream
    last: int
    kept: bool = True


class Scanner:
    """The rules compiled, with the automaton of their keywords."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        kinds = list(KINDS)
        self.order = [(kinds.index(r.kind), i) for i, r in enumerate(rules)]
        self._tried = [re.compile(rf"(?<= )(?:{r.pattern})(?= )") for r in rules]
        by_keyword: dict[str, list[int]] = {}
        for i, rule in enumerate(rules):
            by_keyword.setdefault(rule.keyword, []).append(i)
        self._machine = ahocorasick.Automaton()
        for keyword, numbers in by_keyword.items():
            self._machine.add_word(f" {keyword} ", tuple(numbers))
        self._machine.make_automaton()

    def _near(self, stream: str) -> dict[int, list[list[int]]]:
        """Parts of the stream around each rule's keywords, joined where they meet."""
        parts: dict[int, list[list[int]]] = {}
        for end, numbers in self._machine.iter(stream):
            low, high = max(0, end - REACH), end + REACH
            for number in numbers:
                own = parts.setdefault(number, [])
                if own and low <= own[-1][1]:
                    own[-1][1] = high
                else:
                    own.append([low, high])
        return parts

    def matches(self, stream: str, everywhere: bool = False) -> list[tuple[int, int, int]]:
        """(first, last, rule) of all matches; ``everywhere`` tries all rules without keywords."""
        whole = [[0, len(stream)]]
        parts = dict.fromkeys(range(len(self.rules)), whole) if everywhere else self._near(stream)
        return [
            (m.start(), m.end(), number)
            for number, own in parts.items()
            for low, high in own
            for m in self._tried[number].finditer(stream, low, high)
        ]

    def detections(self, stream: str, everywhere: bool = False) -> list[Detection]:
        """All matches in order, ``kept`` unless one within a better one.

        Matches of one rule don't overlap, so no more of them are open at a place than there are
        rules, however long the text.
        """
        found = sorted(self.matches(stream, everywhere), key=lambda m: (m[0], -m[1], m[2]))

        def rank(m: tuple[int, int, int]) -> tuple[int, int, int]:
            kind, number = self.order[m[2]]
            return kind, m[0] - m[1], number

        out, open_ = [], []
        for i, match in enumerate(found):
            open_ = [m for m in open_ if m[1] > match[0]]
            # those that start here and end here too may come later in the order
            same = []
            for other in found[i + 1 : i + 1 + len(self.rules)]:
                if other[:2] != match[:2]:
                    break
                same.append(other)
            better = any(m[1] >= match[1] and rank(m) < rank(match) for m in (*open_, *same))
            out.append(Detection(match[2], match[0], match[1], not better))
            open_.append(match)
        return out

    def scan(self, text: str | None) -> tuple[int, list[dict]]:
        """Number of words, and the detections with their places in words."""
        words = words_in(text)
        # one character a byte: keywords and expressions name no others than ASCII ones
        stream = f" {b' '.join(words).decode('latin-1')} "
        found = self.detections(stream)
        if not found:
            return len(words), []
        spaces = np.flatnonzero(np.frombuffer(stream.encode("latin-1"), np.uint8) == 32)
        firsts = np.searchsorted(spaces, [d.first for d in found]) - 1
        lasts = np.searchsorted(spaces, [d.last for d in found])
        return len(words), [
            {
                "label": (rule := self.rules[d.rule]).label,
                "kind": rule.kind,
                "base": rule.base,
                "kept": d.kept,
                "first_word": int(a),
                "end_word": int(b),
            }
            for d, a, b in zip(found, firsts, lasts)
        ]


_FOUND = pa.list_(
    pa.struct(
        [
            ("label", pa.string()),
            ("kind", pa.string()),
            ("base", pa.bool_()),
            ("kept", pa.bool_()),
            ("first_word", pa.int64()),
            ("end_word", pa.int64()),
        ]
    )
)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words`` and ``found``, the detections in order of place, of every text."""

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(license_rules())
        for batch in batches(rows, 1 << 24):
            results = [scanner.scan(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([n for n, _ in results], pa.int64()),
                    pa.array([found for _, found in results], _FOUND),
                ],
                names=["doc_id", "n_words", "found"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        scan,
        f"doc_id {kind}, n_words long, found array<struct<label: string, kind: string, "
        "base: boolean, kept: boolean, first_word: bigint, end_word: bigint>>",
    )


def license_labels(found: DataFrame) -> DataFrame:
    """One row per scanned text: base places and labels, all labels, and a score from 0 to 1.

    The score is one minus the product, over the different pairs of label and kind that stay, of
    what each leaves open (``KINDS``): several independent signs say more than one.
    """
    weights = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    base = F.filter("found", lambda d: d["base"])
    signs = F.filter("found", lambda d: d["kept"] | d["base"])
    places = F.transform(base, lambda d: d["first_word"])

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda d: d["label"]))), ",")

    kinds = F.array_sort(
        F.array_distinct(F.transform(signs, lambda d: F.struct(d["label"], d["kind"])))
    )
    open_ = F.aggregate(kinds, F.lit(1.0), lambda left, d: left * (1 - weights[d["kind"]]))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(signs).alias("labels"),
        F.round(1 - open_, 6).alias("score"),
    )
