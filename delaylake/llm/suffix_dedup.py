"""Repeated byte substrings by a sparse suffix array over content-chosen positions."""

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

LENGTH = 200  # bytes of a repeated string
LEAD = 48  # leading bytes by which suffixes are ordered first
BLOCK = 16  # windows per entry of the second level
CHUNK = 1 << 18  # windows handled at once

_BASE = 0x9E3779B97F4A7C15 | 1
_POSITION = np.uint64((1 << 20) - 1)
_EMPTY = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_BASE, CHUNK + 4 * LENGTH)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), CHUNK + 4 * LENGTH)
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)


def _lead_codes(data: np.ndarray) -> np.ndarray:
    """A number for the LEAD bytes from each position, equal for equal bytes."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _POWER[:n], out=sums[1:])
    code = (sums[LEAD:] - sums[: n + 1 - LEAD]) * _INVERSE[: n + 1 - LEAD]
    code ^= code >> np.uint64(31)
    code *= np.uint64(0xD6E8FEB86659FD93)
    code ^= code >> np.uint64(32)
    return code


def _least_positions(codes: np.ndarray, width: int) -> np.ndarray:
    """Position of the least code among ``width`` from each start on, the first of equal ones."""
    n = len(codes)
    marked = (codes & ~_POSITION) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = marked
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - width + 1
    return (np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts]) & _POSITION).astype(np.int64)


def _hashes(data: bytes, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter([digest(data[a:b]) for a, b in zip(first.tolist(), last.tolist())], np.uint64, len(first))


def suffixes(data: bytes, ranges=None) -> Entries:
    """First level: of all suffixes those whose lead is the least within some window; an entry per run of windows that share one.

    A window's choice depends on its bytes only, so equal windows have suffixes of equal lead.
    """
    n = len(data)
    if n < LENGTH:
        return _EMPTY
    view = np.frombuffer(data, np.uint8)
    out: list[Entries] = []
    windows = n - LENGTH + 1
    for at in range(0, windows, CHUNK):
        part = view[at : min(n, at + CHUNK + LENGTH - 1)]
        codes = _lead_codes(part)
        place = _least_positions(codes, LENGTH - LEAD + 1)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        count = np.diff(np.append(first, len(place)))
        start = first + at
        out.append((codes[place[first]], _hashes(data, start, start + count - 1 + LENGTH), start, count))
    return out[0] if len(out) == 1 else tuple(np.concatenate(c) for c in zip(*out))


def blocks(data: bytes, ranges: list[tuple[int, int]]) -> Entries:
    """Second level: runs of at most BLOCK windows, cut at distances from the chosen suffix.

    A block's core is what all its windows share, also where the run ends within it.
    """
    view = np.frombuffer(data, np.uint8)
    cores, fulls, starts, counts = [], [], [], []
    digest = xxhash.xxh3_64_intdigest
    for start, count in ranges:
        last = start + count - 1
        codes = _lead_codes(view[start : last + LENGTH])
        # Positions that every window of the run can see; the chosen one is the least of all.
        place = start + int(_least_positions(codes, len(codes))[0])
        j = (place - last) // BLOCK
        while True:
            low, high = place - BLOCK * j - BLOCK + 1, place - BLOCK * j
            a, b = max(low, start), min(high, last)
            if b < start:
                break
            if a <= b:
                cores.append(digest(data[high : low + LENGTH]))
                fulls.append(digest(data[a : b + LENGTH], (a - low) * BLOCK + b - low))
                starts.append(a)
                counts.append(b - a + 1)
            j += 1
    return np.array(cores, np.uint64), np.array(fulls, np.uint64), np.array(starts, np.int64), np.array(counts, np.int64)


def windows(data: bytes, ranges: list[tuple[int, int]]) -> Entries:
    """Last level: single windows, named by 128 bits."""
    at = np.concatenate([np.arange(s, s + c) for s, c in ranges])
    names = [xxhash.xxh3_128_intdigest(data[i : i + LENGTH]) for i in at.tolist()]
    core = np.array([v >> 64 for v in names], np.uint64)
    full = np.array([v & 0xFFFFFFFFFFFFFFFF for v in names], np.uint64)
    return core, full, at, np.ones(len(at), np.int64)


def removed_runs(ranges: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs, as start and end, of what the windows of these ranges cover."""
    out: list[list[int]] = []
    for start, count in sorted(ranges):
        end = start + count - 1 + length
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


_OUT_DDL = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _cut(batches: Iterator[pa.RecordBatch], with_kept: bool) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
    for batch in batches:
        rows = []
        ids, texts, ranges = batch.columns
        for i in range(batch.num_rows):
            data = texts[i].as_py()
            runs = removed_runs([(r["start"], r["count"]) for r in ranges[i].as_py() or ()], LENGTH)
            kept, at = [], 0
            for a, b in runs:
                kept.append(data[at:a])
                at = b
            kept = b"".join([*kept, data[at:]])
            rows.append((ids[i].as_py(), len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def without_repeats(docs: DataFrame, with_kept: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row (``kept`` bytes on request).

    Every byte goes that a 200-byte string covers which also starts elsewhere in the table, the same document and overlaps included.
    A missing or empty text has no bytes and keeps none; a row that is repeated repeats all its strings. Rows without doc_id
    take part. Long texts are read in chunks. Other columns are not read; an empty table gives an empty result.
    """
    found = repeated_windows(docs, [suffixes, blocks, windows], earlier=False, per_kb=1000 / 70, purpose="suffixes")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), row_key("doc_id", "text").alias("key"), text_of().cast("binary").alias("text")
    )
    joined = rows.join(found, "key", "left").select("doc_id", "text", "ranges")
    cut = joined.mapInArrow(lambda batches: _cut(batches, with_kept), _OUT_DDL)
    return cut if with_kept else cut.drop("kept")


@register()
def op7_suffix_dedup(spark, sf_dir):
    """Repeated 200-byte strings removed from all documents."""
    return without_repeats(table(spark, sf_dir, "documents"))
