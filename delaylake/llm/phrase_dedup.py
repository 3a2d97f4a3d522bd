"""Repeated word windows by recompression: locally consistent names for word pairs, round by round."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import register, row_key, table, text_of
from .repeats import Entries, repeated_windows
from .suffix_dedup import _EMPTY, removed_runs

LENGTH = 13  # words of a window
ROUNDS = 2  # symbols of at most four words, so that every window holds one with all it depends on
MARGIN = 1  # further words on either side; the outermost are part of what a run of windows is named by


def _mixed(a: np.ndarray, salt: int) -> np.ndarray:
    h = a ^ np.uint64(salt)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


_SALTS = (0x1B873593CC9E2D51, 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D)


def word_names(data: bytes) -> np.ndarray:
    words = data.split()
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words))


def recompressed(names: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after some rounds, with the first and past-the-last word that each depends on.

    A round gives every symbol a side by its name; a left one directly before a right one makes a pair, whose name
    comes from theirs alone. So where a pair or single symbol stands depends on its neighbours only, and equal
    passages get equal symbols inside. Runs of one word never pair, and stay as they are within these rounds.
    Names are hashes of content, agreed by all executors without an exchange; what they suggest is verified on names of whole
    windows.
    """
    symbol = names
    low = np.arange(len(names), dtype=np.int64)
    high = low + 1
    for r in range(rounds):
        n = len(symbol)
        if not n:
            break
        right = (_mixed(symbol, _SALTS[r]) & np.uint64(1)).astype(bool)
        pairs = np.zeros(n, bool)
        pairs[:-1] = ~right[:-1] & right[1:]
        second = np.zeros(n, bool)
        second[1:] = pairs[:-1]
        # A single symbol also depends on the neighbour it might have paired with; beyond the text there is none to ask.
        beyond_low, beyond_high = np.append(-1, low[:-1]), np.append(high[1:], len(names) + 1)
        new_low = np.where(right & ~second, np.minimum(low, beyond_low), low)
        new_high = np.where(~right & ~pairs, np.maximum(high, beyond_high), high)
        if n > 1:
            at = np.flatnonzero(pairs)
            new_low[at], new_high[at] = np.minimum(low[at], low[at + 1]), np.maximum(high[at], high[at + 1])
            named = symbol.copy()
            named[at] = _mixed(symbol[at] * np.uint64(0x9E3779B97F4A7C15) + symbol[at + 1], _SALTS[-1])
        else:
            named = symbol
        keep = ~second
        symbol, low, high = named[keep], new_low[keep], new_high[keep]
    return symbol, low, high


def _span_names(names: np.ndarray, first: np.ndarray, last: np.ndarray, salt: int) -> np.ndarray:
    data = names.tobytes()
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(
        [digest(data[8 * a : 8 * b], salt) for a, b in zip(first.tolist(), last.tolist())], np.uint64, len(first)
    )


def phrases(data: bytes, ranges=None) -> Entries:
    """First level: runs of windows whose least symbol, among those decided within the window, is the same."""
    names = word_names(data)
    n = len(names)
    if n < LENGTH:
        return _EMPTY
    symbol, low, high = recompressed(names)
    low, high = low - MARGIN, high + MARGIN
    inside = (low >= 0) & (high <= n)
    low, high = low[inside], high[inside]
    # Both ends rise from symbol to symbol, so a window's symbols are those from one index to another.
    rank = _mixed(_mixed(symbol[inside] + names[low], _SALTS[0]) + names[high - 1], _SALTS[1])
    windows = n - LENGTH + 1
    at = np.arange(windows)
    begin = np.searchsorted(low, at, "left")
    owner = begin.copy()
    end = np.searchsorted(high, at + LENGTH, "right")
    best = rank[owner]
    for step in range(1, int((end - owner).max())):
        k = begin + step
        value = rank[np.minimum(k, len(rank) - 1)]
        better = (k < end) & (value < best)
        best[better] = value[better]
        owner[better] = k[better]
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    count = np.diff(np.append(first, windows))
    full = _span_names(names, first, first + count - 1 + LENGTH, 2)
    return best[first], full, first, count


def word_windows(data: bytes, ranges: list[tuple[int, int]]) -> Entries:
    """Last level: single windows, named by 128 bits."""
    names = word_names(data).tobytes()
    at = np.concatenate([np.arange(s, s + c) for s, c in ranges])
    found = [xxhash.xxh3_128_intdigest(names[8 * i : 8 * (i + LENGTH)]) for i in at.tolist()]
    core = np.array([v >> 64 for v in found], np.uint64)
    full = np.array([v & 0xFFFFFFFFFFFFFFFF for v in found], np.uint64)
    return core, full, at, np.ones(len(at), np.int64)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
_OUT_DDL = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept binary"


def _cut(batches: Iterator[pa.RecordBatch], with_kept: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        ids, texts, ranges = batch.columns
        for i in range(batch.num_rows):
            words = texts[i].as_py().split()
            kept, at = [], 0
            for a, b in removed_runs([(r["start"], r["count"]) for r in ranges[i].as_py() or ()], LENGTH):
                kept += words[at:a]
                at = b
            kept += words[at:]
            text = b" ".join(kept)
            rows.append((ids[i].as_py(), len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest(), text if with_kept else None))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)], schema=_OUT)


def without_earlier_passages(docs: DataFrame, with_kept: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row (``kept`` text on request).

    Every word goes that a window of 13 words covers whose words also start in a row of smaller doc_id. Rows of equal
    doc_id do not count against each other; one without doc_id loses nothing and costs others nothing. A missing text has no
    words. Other columns are not read; an empty table gives an empty result.
    """
    found = repeated_windows(docs, [phrases, word_windows], earlier=True, per_kb=1000 / 30, purpose="phrases")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), row_key("doc_id", "text").alias("key"), text_of().cast("binary").alias("text")
    )
    joined = rows.join(found, "key", "left").select("doc_id", "text", "ranges")
    cut = joined.mapInArrow(lambda batches: _cut(batches, with_kept), _OUT_DDL)
    return cut if with_kept else cut.drop("kept")


@register(r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)
),
first AS (SELECT k, min(doc_id) AS d FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, i + s AS p
  FROM (SELECT doc_id, i, unnest(range(13)) AS s FROM windows JOIN first USING (k) WHERE d < doc_id)
),
placed AS (SELECT doc_id, p, ws[p] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w)),
kept AS (
  SELECT placed.doc_id, count(gone.p) AS n_removed,
         string_agg(word, ' ' ORDER BY placed.p) FILTER (gone.p IS NULL) AS text
  FROM placed LEFT JOIN gone ON placed.doc_id = gone.doc_id AND placed.p = gone.p GROUP BY placed.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
""")
def op8_substring_dedup(spark, sf_dir):
    """Passages of 13 words that an earlier document has removed from all documents."""
    return without_earlier_passages(table(spark, sf_dir, "documents"))
