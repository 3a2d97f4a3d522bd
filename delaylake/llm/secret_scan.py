"""Secret scan: assignments lexed into names and literals, constants propagated, literals scored by their names."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import register, table

# The base patterns, in the order of their kinds; only ASCII letters in either case.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "literal")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_LONG_HEX = re.compile(r"[0-9a-f]{24}")

# What a name's words say of the value assigned to it.
NAME_SCORES = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "passcode": 3, "secret": 3, "apikey": 3, "token": 2, "credential": 2,
    "credentials": 2, "bearer": 2, "signature": 1, "auth": 1, "private": 1, "access": 1, "key": 1, "pin": 1, "salt": 1,
    "accesskey": 2, "privatekey": 2, "signingkey": 2,
}
PLACEHOLDERS = {"changeme", "example", "password", "secret", "token", "none", "null", "true", "false", "undefined", "todo", "xxx"}
REPORT_FROM = 5
MOST_VALUE = 1024  # a longer sum of literals is no secret, and stands for no name

# A name, the type that some languages declare between it and the sign, and the sign of an assignment.
_NAME = re.compile(
    r"""(?<![\w$.\-])([A-Za-z_$][\w$.\-]*+)["'`]?\]?[ \t]*+"""
    r"""(?::[ \t]*+[A-Za-z_][\w.<>\[\]|? ]{0,60}(?<! )[ \t]*+=(?![=>])|:=|=>|=(?![=>])|:(?![:/=]))[ \t]*+"""
)
_QUOTED = re.compile(r"""(["'`])((?:\\.|(?!\1)[^\\\n])*)\1""")
_BARE = re.compile(r"""[^\s,;#"'`(){}\[\]+]+""")
_JOIN = re.compile(r"[ \t]*\+[ \t]*")
_REFERENCE = re.compile(r"[A-Za-z_$][\w$.\-]*\Z")
_NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

Span = tuple[int, int]


@dataclass(frozen=True)
class Constant:
    value: str
    spans: tuple[Span, ...]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost matches per kind that do not overlap; matches that are too short are dropped afterwards."""
    found = []
    lower = text.lower()
    if any(w in lower for w in _ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if _LONG_HEX.search(text):
        found += [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return found


def _value(text: str, at: int, known: dict[str, Constant]) -> Constant | None:
    """The literal or the sum of literals and known names that starts at ``at``."""
    parts: list[str] = []
    spans: list[Span] = []
    while True:
        if m := _QUOTED.match(text, at):
            parts.append(m[2])
            spans.append(m.span(2))
        elif m := _BARE.match(text, at):
            constant = known.get(m[0]) if _REFERENCE.match(m[0]) else None
            parts.append(constant.value if constant else m[0])
            spans += constant.spans if constant else [m.span()]
        else:
            break
        more = _JOIN.match(text, m.end())
        if not more:
            break
        at = more.end()
    return Constant("".join(parts), tuple(dict.fromkeys(spans))) if parts else None


def assignments(text: str) -> Iterator[tuple[str, Constant]]:
    """Names and the constants assigned to them, in order; a name later used as a value stands for its constant."""
    known: dict[str, Constant] = {}
    end = -1
    for line in text.split("\n"):
        start, end = end + 1, end + 1 + len(line)
        if "=" not in line and ":" not in line:
            continue
        for m in _NAME.finditer(text, start, end):
            value = _value(text, m.end(), known)
            if value is None:
                continue
            if len(value.value) <= MOST_VALUE:
                known[m[1]] = value
            else:
                known.pop(m[1], None)
            yield m[1], value


def name_score(name: str) -> int:
    words = [w.lower() for w in _NAME_WORD.findall(name)]
    pairs = [a + b for a, b in zip(words, words[1:])]
    return sum(NAME_SCORES.get(w, 0) for w in words + pairs)


def literal_score(value: str) -> int:
    """Length, mixture and spread of characters speak for a secret; blanks, calls and placeholders against it."""
    if value.lower() in PLACEHOLDERS or re.search(r"\s|\$\{|<[^>]*>|\*{3}", value):
        return -9
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values()) if value else 0.0
    kinds = sum(any(test(c) for c in counts) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return (len(value) >= 6) + (len(value) >= 16) + (entropy >= 2.5) + (kinds >= 2) + (kinds >= 3)


def secret_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans and the literals whose sensitive names and own looks score enough, by start, then kind."""
    found = set(base_spans(text))
    if "=" in text or ":" in text:
        for name, constant in assignments(text):
            named = name_score(name)
            if named >= 2 and named + literal_score(constant.value) >= REPORT_FROM:
                found |= {("literal", *s) for s in constant.spans}
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_OUT = pa.schema(
    [("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string())]
)
_OUT_DDL = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_literal bigint, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            spans = secret_spans(text or "")
            counts = Counter(k for k, _, _ in spans)
            base = joined(s for s in spans if s[0] != "literal")
            rows.append((doc_id, *(counts[k] for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), joined(spans)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)], schema=_OUT)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_literal, base_sha256, spans`` for every row.

    Spans count code points, ends exclusive, of whole texts; a missing text is empty and has none. Texts are scanned where
    they are read, repeated rows alike, in time linear in their length, lines of any length included. Other columns are not read; an empty table
    gives an empty result.
    """
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_scan, _OUT_DDL)


@register()
def op3_secret_scans(spark, sf_dir):
    """Secrets in all documents."""
    return scan_secrets(table(spark, sf_dir, "documents"))
