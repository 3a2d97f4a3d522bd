"""URL filters: glob rules packed into multiword Shift-And masks, all simulated at once over each URL."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import register, table

WORD = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        """Over ``.host/path``: any run without a slash, the host after a dot, the path, then anything."""
        return f"*.{self.host}{self.path}**"


class ShiftAnd:
    """An automaton of all patterns at once.

    ``*`` matches any run of bytes without a slash, ``**`` any run at all, every other byte itself. Bit
    positions of the patterns lie side by side over as many 64-bit words as they need. A bit is set when
    its pattern's prefix up to there matches what has been read; a star keeps the bit before it alive.
    """

    def __init__(self, patterns: Sequence[str]):
        literal: list[int] = [] # the byte that enters each position
        stars: list[tuple[int, bool]] = []
        self.ends: list[int] = []
        starts: list[int] = []
        for pattern in patterns:
            literal.append(-1)  # position 0 of a pattern: nothing read yet
            starts.append(len(literal) - 1)
            data, i = pattern.encode(), 0
            while i < len(data):
                if data[i] == 42:
                    deep = data[i : i + 2] == b"**"
                    stars.append((len(literal) - 1, deep))
                    i += 2 if deep else 1
                else:
                    literal.append(data[i])
                    i += 1
            self.ends.append(len(literal) - 1)
        self.words = max(1, -(-len(literal) // WORD))
        self.enter = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.first = np.zeros(self.words, np.uint64)
        bit = lambda p: (p // WORD, np.uint64(1 << (p % WORD)))
        for p, byte in enumerate(literal):
            if byte >= 0:
                w, b = bit(p)
                self.enter[byte, w] |= b
        for p, deep in stars:
            w, b = bit(p)
            for byte in range(256):
                if deep or byte != 47:
                    self.stay[byte, w] |= b
        for p in starts:
            w, b = bit(p)
            self.first[w] |= b

    def run(self, texts: Sequence[bytes]) -> np.ndarray:
        """Row per text, column per pattern: whether the whole text matches."""
        state = np.tile(self.first, (len(texts), 1))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")  # texts still being read are a prefix of this order
        starts = np.zeros(len(texts), np.int64)
        np.cumsum(lengths[:-1], out=starts[1:])
        data = np.frombuffer(b"".join(texts), np.uint8)
        falling = -lengths[order]
        current = state[order]
        offsets = starts[order]
        for position in range(int(lengths.max(initial=0))):
            live = int(np.searchsorted(falling, -position, "left"))  # longer than position
            byte = data[offsets[:live] + position]
            now = current[:live]
            shifted = now << np.uint64(1)
            shifted[:, 1:] |= now[:, :-1] >> np.uint64(WORD - 1)
            current[:live] = (shifted & self.enter[byte]) | (now & self.stay[byte])
        state[order] = current
        ends = np.array(self.ends)
        return (state[:, ends // WORD] >> (ends % WORD).astype(np.uint64)) & np.uint64(1) != 0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    plain = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    host = F.substring_index(plain, "/", 1)
    return F.translate(host, UPPER, LOWER), F.substring(plain, F.length(host) + 1, F.length(plain))


def canonical_form(host: Column, path: Column) -> Column:
    """``.host/path`` without user, port, dots at the host's end, empty and dot segments; a missing path is ``/``."""
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^[^@]*@", ""), ":[0-9]*$", ""), "[.]+$", "")
    path = F.regexp_replace(path, "(/[.]?)+/", "/")
    return F.concat(F.lit("."), host, F.when(path == "", "/").otherwise(path))


def glob_regex(glob: str) -> str:
    """A glob as a regular expression over the whole text, for engines that have no such automaton."""
    return "(?s)" + ".*".join("[^/]*".join(re.escape(part) for part in run.split("*")) for run in glob.split("**"))


def _fits(globs: Sequence[str], text: Column) -> Column:
    """The number of the first glob that fits the whole text, or -1; one automaton runs all of them over a batch."""
    automaton = ShiftAnd(globs) if globs else None

    @F.pandas_udf("int")
    def first(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if automaton is None or not len(texts):
                yield pd.Series(np.full(len(texts), -1, np.int32))
                continue
            found = automaton.run([t.encode() for t in texts])
            yield pd.Series(np.where(found.any(1), found.argmax(1), -1).astype(np.int32))

    return first(text)


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url", key: str = "page_id", patterns: Sequence[str] = ()
) -> DataFrame:
    """``key, host, path, rule, verdict`` and ``pattern`` for every row.

    A rule fits its host and all subdomains when the path starts with its path; of several the longest
    wins, and of equally long ones the earlier. Without one, ``rule`` is null and the ``patterns`` decide, globs over the canonical
    URL (``canonical_form``): ``block`` and the first that fits, else ``default``. A URL that is missing or has no ``://`` has an
    empty host and path, which no rule fits. Repeated rows are judged alike, long URLs are read to their end, other columns are not
    read, and an empty table gives an empty result. The automata's sizes follow rules and patterns, not the data; URLs
    are judged where they are read, without a shuffle.
    """
    ranked = sorted(rules, key=lambda r: -len(r.text))
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    rows = rows.withColumns(
        {
            "__rule": _fits([r.glob for r in ranked], F.concat(F.lit("."), "host", "path")),
            "__pattern": _fits(patterns, canonical_form(F.col("host"), F.col("path"))),
        }
    )

    def picked(place: Column, values: Sequence[str]) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), place) if values else F.lit(None).cast("string")

    ruled, matched = F.col("__rule") >= 0, F.col("__pattern") >= 0
    verdict = F.when(ruled, picked(F.col("__rule"), [r.verdict for r in ranked])).when(matched, F.lit("block")).otherwise(default)
    return rows.select(
        key, "host", "path",
        F.when(ruled, picked(F.col("__rule"), [r.text for r in ranked])).alias("rule"),
        verdict.alias("verdict"),
        F.when(~ruled & matched, picked(F.col("__pattern"), patterns)).alias("pattern"),
    )


# The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

#: What the registered query blocks where no rule speaks: words of spam and gambling that stand alone in a host, and pages without content.
PATTERNS = (
    *[f"*.{word}-*/**" for word in ("spam", "casino", "poker", "bets", "warez")],
    *[f"*-{word}.*/**" for word in ("spam", "casino", "poker", "bets", "warez")],
    "**/wp-login.php", "**/cgi-bin/**", "**/calendar/**/calendar/**",
)


@register(r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
part AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
),
ruled AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM part
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' WHEN rule IS NULL AND (@) THEN 'block'
            ELSE 'allow' END AS verdict
FROM (SELECT *, '.' || regexp_replace(regexp_replace(regexp_replace(host, '^[^@]*@', ''), ':[0-9]*$', ''), '[.]+$', '')
                || CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '(/[.]?)+/', '/', 'g') END AS canonical FROM ruled)
""".replace("@)", " OR ".join(f"regexp_full_match(canonical, '{glob_regex(p)}')" for p in PATTERNS) + ")"))
def op5_url_filters(spark, sf_dir):
    """Every page's URL judged by the fixed rules, and by patterns where no rule speaks."""
    return judge_urls(table(spark, sf_dir, "pages"), RULES, patterns=PATTERNS).drop("pattern")
