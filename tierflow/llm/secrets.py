"""Secret scans: keyword automaton, anchored expressions near its hits, checksums where tokens have one.

An Aho-Corasick automaton reads each text once; only where one of its keywords stands is an
expression tried, anchored at that place. Runs of hexadecimal digits have no keyword and are
found by an expression of their own. Tokens that carry a checksum count only if it is right.

Defined results: a null or empty text has no spans; repeated rows are scanned each; an empty table
gives no rows; other columns of the input are passed on by ``redact_secrets``. Places are code
points, ends exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batches, small_batches

#: Kinds in the order in which spans at one place are listed; the first three are the base rules.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "jwt", "slack", "stripe", "google", "pem", "url")

# What the kinds look like, from the place of their keyword on.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_NPM = re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{6,}\.eyJ[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]{16,}")
_SLACK = re.compile(r"xox[abprs]-[A-Za-z0-9]+(?:-[A-Za-z0-9]+)+")
_STRIPE = re.compile(r"(?:sk|rk)_live_[A-Za-z0-9]{16,}")
_GOOGLE = re.compile(r"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])")
_PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END (?:[A-Z]+ )*PRIVATE KEY-----)?")
_URL = re.compile(r"://[A-Za-z0-9._%+-]+:[^\s:@/]{4,}@[A-Za-z0-9.-]+")

#: Keyword (lower case), kind and expression, to be tried where the keyword starts.
KEYWORDS = (
    ("password", "assign", _ASSIGN),
    ("passwd", "assign", _ASSIGN),
    ("secret", "assign", _ASSIGN),
    ("token", "assign", _ASSIGN),
    ("apikey", "assign", _ASSIGN),
    ("api_key", "assign", _ASSIGN),
    ("akia", "access", _ACCESS),
    ("ghp_", "github", _GITHUB),
    ("gho_", "github", _GITHUB),
    ("ghu_", "github", _GITHUB),
    ("ghs_", "github", _GITHUB),
    ("ghr_", "github", _GITHUB),
    ("npm_", "npm", _NPM),
    ("eyj", "jwt", _JWT),
    ("xox", "slack", _SLACK),
    ("sk_live_", "stripe", _STRIPE),
    ("rk_live_", "stripe", _STRIPE),
    ("aiza", "google", _GOOGLE),
    ("-----begin ", "pem", _PEM),
    ("://", "url", _URL),
)

_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc_suffix(value: str) -> bool:
    """Whether the last six base-62 digits are the CRC-32 of what stands between ``_`` and them."""
    body = value.partition("_")[2]
    crc = 0
    for digit in body[-6:]:
        crc = crc * 62 + _DIGITS.index(digit)
    return crc == zlib.crc32(body[:-6].encode())


def _jwt_header(value: str) -> bool:
    head = value.partition(".")[0]
    try:
        fields = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(fields, dict) and "alg" in fields


def _valid(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return match.end(2) - match.start(2) >= 8
    if kind == "access":
        return match.end() - match.start() >= 16
    if kind in ("github", "npm"):
        return _crc_suffix(match.group())
    if kind == "jwt":
        return _jwt_header(match.group())
    return True


def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for word, kind, expression in KEYWORDS:
        machine.add_word(word, (len(word), kind, expression))
    machine.make_automaton()
    return machine


def _ascii_lower(text: str) -> str:
    """As long as the text: other letters than A-Z stay, as some change their length."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def find_secrets(text: str | None, machine: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in order of start, then kind; those of one kind don't overlap."""
    if not text:
        return []
    hits = [(end - n + 1, kind, rx) for end, (n, kind, rx) in machine.iter(_ascii_lower(text))]
    spans, over = [], {}
    for start, kind, expression in sorted(hits, key=lambda h: h[0]):
        if start < over.get(kind, 0):
            continue
        if match := expression.match(text, start):
            over[kind] = match.end()  # a match that fails its check isn't tried again inside
            if _valid(kind, match):
                spans.append((kind, start, match.end()))
    spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by its first kind in brackets."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``counts`` by base kind, ``base`` and ``spans`` (comma-joined) of each text."""

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton()
        for batch in batches(rows, 1 << 24):
            found = [find_secrets(t, machine) for t in batch.column("text").to_pylist()]
            base = [[s for s in spans if s[0] in BASE_KINDS] for spans in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in BASE_KINDS],
                    pa.array([hashlib.sha256(listed(x).encode()).hexdigest() for x in base], pa.string()),
                    pa.array([listed(x) for x in found], pa.string()),
                ],
                names=["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans"],
            )

    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {kind}, {counts}, base_sha256 string, spans string"
    )


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets of ``text`` replaced; null texts and other columns stay.

    Texts are taken from a batch some megabytes at a time, whole rows go on.
    """
    small_batches(docs.sparkSession)

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton()
        for batch in batches(rows, 1 << 21):
            place = batch.schema.get_field_index("text")
            texts = [
                t and redacted(t, find_secrets(t, machine)) for t in batch.column(place).to_pylist()
            ]
            changed = pa.array(texts, batch.schema.field(place).type)
            yield batch.set_column(place, batch.schema.field(place), changed)

    return docs.mapInArrow(scan, docs.schema)
