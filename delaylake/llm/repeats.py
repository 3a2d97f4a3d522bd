"""Repeated windows over a corpus: entries that cover runs of windows, range-partitioned, sorted and compared with neighbours.

An entry stands for the windows that start at ``start .. start + count - 1`` of one row. Its ``core`` names content
that lies inside every one of them, its ``full`` all content they cover. Equal windows have entries of equal core, so

* entries equal in core and full repeat each other whole;
* a core with a single full, and that once, covers no repeated window;
* the rest, cores with several fulls, goes to the next level, whose entries cover fewer windows each; those of the last
  level cover one.

Entries move as packed arrays, one per task and bucket. Buckets are ranges of (core, full, document, start) between
sampled splitters, so a core or window that a third of all rows contain is cut into as many buckets as
it needs; what a bucket's first and last core need from its neighbours comes from a table of one row per bucket.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, text_of, written

BUCKET_ENTRIES = 100_000  # aimed at per bucket,
MOST_BUCKETS, MOST_ENTRIES = 50_000, 4_000_000  # more where that makes too many buckets, up to what a task may hold
FLUSH_ENTRIES = 150_000  # a task packs its entries when it holds so many
SAMPLE_PER_BUCKET, SAMPLE_PER_ROW = 24, 24

#: Entries of a text: core, full (uint64), start (int64), count (int64). Later levels get the ranges to look into.
Entries = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
Generate = Callable[[bytes, "list[tuple[int, int]] | None"], Entries]


@dataclass
class _Held:
    core: list = field(default_factory=list)
    full: list = field(default_factory=list)
    start: list = field(default_factory=list)
    count: list = field(default_factory=list)
    owner: list = field(default_factory=list)
    docs: list = field(default_factory=list)
    keys: list = field(default_factory=list)
    size: int = 0

    def add(self, entries: Entries, doc: int, key: int) -> None:
        core, full, start, count = entries
        if not len(core):
            return
        self.core.append(core)
        self.full.append(full)
        self.start.append(start)
        self.count.append(count)
        self.owner.append(np.full(len(core), len(self.docs), np.uint32))
        self.docs.append(doc)
        self.keys.append(key)
        self.size += len(core)


def _pack(core, full, start, count, owner, docs, keys) -> bytes:
    used, owner = np.unique(owner, return_inverse=True)
    head = struct.pack("<2q", len(core), len(used))
    parts = (core, full, start.astype("<i8"), count.astype("<u4"), owner.astype("<u4"), docs[used], keys[used])
    return head + b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


def _unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    n, m = struct.unpack_from("<2q", blob)
    at, out = 16, []
    for kind, size in (("<u8", n), ("<u8", n), ("<i8", n), ("<u4", n), ("<u4", n), ("<i8", m), ("<i8", m)):
        out.append(np.frombuffer(blob, kind, size, at))
        at += out[-1].nbytes
    core, full, start, count, owner, docs, keys = out
    return core, full, docs[owner], keys[owner], start, count.astype(np.int64)


def multikey_order(*keys: np.ndarray) -> np.ndarray:
    """Order by the first key, then among equals only by the second, and so on."""
    order = np.argsort(keys[0], kind="stable")
    for depth in range(1, len(keys)):
        tied = np.ones(len(order), bool)
        if not len(order):
            return order
        same = np.ones(len(order) - 1, bool)
        for k in keys[:depth]:
            s = k[order]
            same &= s[1:] == s[:-1]
        tied[:] = False
        tied[1:] |= same
        tied[:-1] |= same
        where = np.flatnonzero(tied)
        if not len(where):
            return order
        group = np.cumsum(np.concatenate(([True], ~same)))[where]
        part = order[where]
        order[where] = part[np.lexsort((keys[depth][part], group))]
    return order


def _sort_key(core: np.ndarray, full: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Order of entries as fixed-length byte strings, for the search among splitters."""
    out = np.empty((len(core), 4), ">u8")
    out[:, 0], out[:, 1] = core, full
    out[:, 2] = doc.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    out[:, 3] = start.astype(np.uint64)
    return np.ascontiguousarray(out).view("S32").ravel()


def _bucket_of(splitters: np.ndarray, held: tuple) -> np.ndarray:
    core, full, start, _, owner, docs, _ = held
    firsts = splitters.view(">u8").reshape(-1, 4)[:, 0].astype(np.uint64) if len(splitters) else np.zeros(0, np.uint64)
    bucket = np.searchsorted(firsts, core, "right")
    unsure = np.flatnonzero(np.searchsorted(firsts, core, "left") != bucket)
    if len(unsure):  # the core itself is a splitter's: compare all of the key
        keys = _sort_key(core[unsure], full[unsure], docs[owner[unsure]], start[unsure])
        bucket[unsure] = np.searchsorted(splitters, keys, "right")
    return bucket


def _texts(batch: pa.RecordBatch):
    columns = {n: batch.column(n) for n in batch.schema.names}
    ranges = columns["ranges"].to_pylist() if "ranges" in columns else None
    texts = columns["text"]
    for i in range(batch.num_rows):
        text = texts[i].as_py()
        found = None if ranges is None else [(r["start"], r["count"]) for r in ranges[i]]
        yield columns["doc_id"][i].as_py(), columns["key"][i].as_py(), text, found


def _splitters(rows: DataFrame, generate: Generate, buckets: int, total: int) -> np.ndarray:
    """Quantiles of the keys of a sample of rows, chosen by hash; its size follows the number of buckets."""
    if buckets <= 1:
        return np.zeros(0, "S32")
    wanted = max(500, buckets * SAMPLE_PER_BUCKET // SAMPLE_PER_ROW * 4)
    every = max(1, total // wanted)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, key, text, ranges in _texts(batch):
                core, full, start, count = generate(text, ranges)
                pick = np.random.default_rng(key & 0xFFFF).permutation(len(core))[:SAMPLE_PER_ROW]
                if len(pick):
                    docs = np.full(len(pick), doc, np.int64)
                    keys = np.ascontiguousarray(_sort_key(core[pick], full[pick], docs, start[pick]))
                    weight = len(core) / len(pick)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([keys.tobytes()], pa.binary()), pa.array([weight], pa.float64())], names=["k", "w"]
                    )

    chosen = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "key"), F.lit(every)) == 0)
    got = chosen.mapInArrow(sample, "k binary, w double").collect()
    if not got:
        return np.zeros(0, "S32")
    parts = [np.frombuffer(bytes(r["k"]), np.dtype("V32")).view("S32") for r in got]
    weights = np.concatenate([np.full(len(p), r["w"]) for p, r in zip(parts, got)])
    keys = np.concatenate(parts)
    # Padded comparison of S32 keys ignores trailing zero bytes, alike here and in the search.
    order = np.argsort(keys, kind="stable")
    reached = np.cumsum(weights[order])
    at = np.searchsorted(reached, reached[-1] * np.arange(1, buckets) / buckets)
    return keys[order][np.minimum(at, len(keys) - 1)]


REPEATED, DETAIL, PENDING, EDGE = range(4)
_RESULT = (
    "kind tinyint, bucket int, core bigint, full bigint, doc bigint, key bigint, start bigint, count bigint, "
    "first_full bigint, last_full bigint, first_doc bigint, twice boolean"
)


def _compare(rows: pa.Table, earlier: bool) -> pa.Table:
    """One bucket, sorted: what its neighbours within decide, and what waits for those in other buckets.

    REPEATED entries are done; DETAIL go to the next level; PENDING are those whose answer other buckets may
    change: a few entries of the first and last core, however many entries share it. Two EDGE rows, the first and the
    last entry, tell the other buckets of these.
    """
    parts = [_unpack(b.as_py()) for b in rows.column("blob")]
    core, full, doc, key, start, count = (np.concatenate(c) for c in zip(*parts))
    order = multikey_order(core, full, doc, start)
    core, full, doc, key, start, count = (a[order] for a in (core, full, doc, key, start, count))
    n = len(core)
    new_core = np.concatenate(([True], core[1:] != core[:-1]))
    new_full = new_core | np.concatenate(([True], full[1:] != full[:-1]))
    core_at, full_at = np.flatnonzero(new_core), np.flatnonzero(new_full)
    core_run, full_run = np.cumsum(new_core) - 1, np.cumsum(new_full) - 1
    core_end, full_end = np.append(core_at[1:], n), np.append(full_at[1:], n)
    first_full, last_full = full[core_at][core_run], full[core_end - 1][core_run]
    first_doc = doc[full_at][full_run]
    twice = ((full_end - full_at) > 1)[full_run]
    repeated = doc > first_doc if earlier else twice
    several = first_full != last_full
    # One entry stands for a repeated run at the next level; with ``earlier``, those of the first document.
    leads = doc == first_doc if earlier else new_full
    outer_core = (core_run == 0) | (core_run == core_run[-1])
    if earlier:  # an earlier bucket may hold a smaller document for the first run
        pending = (full_run == 0) & leads
    else:  # a single entry at the border may have an equal one beyond it
        pending = ((full_run == 0) | (full_run == full_run[-1])) & ~twice
    pending |= outer_core & ~several & leads  # another bucket may hold another full of the core
    signed = lambda a: np.ascontiguousarray(a).view(np.int64)
    bucket = rows.column("bucket")[0].as_py()

    def out(kind: int, at: np.ndarray, whole: bool) -> pa.Table:
        m = len(at)
        part = lambda a: signed(a[at]) if whole else np.zeros(m, np.int64)
        columns = [
            np.full(m, kind, np.int8), np.full(m, bucket, np.int32), part(core), part(full), part(doc), key[at], start[at], count[at],
            part(first_full), part(last_full), part(first_doc), twice[at],
        ]
        return pa.table(dict(zip(_NAMES, map(pa.array, columns))))

    return pa.concat_tables(
        [
            out(REPEATED, np.flatnonzero(repeated), False),
            out(DETAIL, np.flatnonzero(several & leads), False),
            out(PENDING, np.flatnonzero(pending), True),
            out(EDGE, np.array([0, n - 1]), True),
        ]
    )


_NAMES = [c.split()[0] for c in _RESULT.split(", ")]


def _carried(edges: list) -> list[tuple]:
    """Per bucket: the core and full that end before it with their first full and document, and what follows it.

    ``edges``: two rows per bucket, its first and last entry in order. Values are compared as given.
    """
    pairs = [(edges[i], edges[i + 1]) for i in range(0, len(edges), 2)]
    before: list[tuple] = []
    held = None  # core, full, first_full, first_doc of the last entry so far
    for first, last in pairs:
        before.append(held)
        same_core = held is not None and held[0] == last["core"]
        same_full = same_core and held[1] == last["full"]
        # The last entry's own run begins in this bucket unless it began before it.
        held = (
            last["core"],
            last["full"],
            held[2] if same_core else last["first_full"],
            held[3] if same_full else last["first_doc"],
        )
    after: list[tuple] = []
    held = None  # core, full of the next entry, last full of its core's run
    for first, last in reversed(pairs):
        after.append(held)
        same_core = held is not None and held[0] == first["core"]
        held = (first["core"], first["full"], held[2] if same_core else first["last_full"])
    after.reverse()
    none4, none3 = (None,) * 4, (None,) * 3
    return [(p[0]["bucket"], *(b or none4), *(a or none3)) for p, b, a in zip(pairs, before, after)]


def _buckets(entries: int) -> int:
    return max(1, entries // max(BUCKET_ENTRIES, min(MOST_ENTRIES, entries // MOST_BUCKETS)))


def _level(rows: DataFrame, generate: Generate, earlier: bool, entries: int, total: int, purpose: str) -> DataFrame:
    """``kind`` (REPEATED or DETAIL), ``key, start, count`` for the entries of one level."""
    spark = rows.sparkSession
    splitters = _splitters(rows, generate, _buckets(entries), total)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()

        def flushed():
            arrays = tuple(np.concatenate(c) for c in (held.core, held.full, held.start, held.count, held.owner))
            arrays += (np.array(held.docs, np.int64), np.array(held.keys, np.int64))
            bucket = _bucket_of(splitters, arrays)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            names, blobs = [], []
            for at in np.split(order, cuts):
                names.append(int(bucket[at[0]]))
                blobs.append(_pack(*(a[at] for a in arrays[:5]), *arrays[5:]))
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

        for batch in batches:
            for doc, key, text, ranges in _texts(batch):
                held.add(generate(text, ranges), doc, key)
                if held.size >= FLUSH_ENTRIES:
                    yield flushed()
                    held = _Held()
        if held.size:
            yield flushed()

    packed = rows.mapInArrow(pack, "bucket int, blob binary")
    compared = written(packed.groupBy("bucket").applyInArrow(lambda r: _compare(r, earlier), _RESULT), purpose)
    edges = compared.where(F.col("kind") == EDGE).select("bucket", "core", "full", "first_full", "last_full", "first_doc", "start", "doc")
    carried = _carried(_edge_order(edges.collect()))
    schema = "b int, p_core bigint, p_full bigint, p_first_full bigint, p_first_doc bigint, n_core bigint, n_full bigint, n_last_full bigint"
    around = spark.createDataFrame(carried, schema)
    waiting = compared.where(F.col("kind") == PENDING).join(F.broadcast(around), F.col("bucket") == F.col("b"))
    before = F.coalesce(F.col("p_core") == F.col("core"), F.lit(False))
    beyond = F.coalesce(F.col("n_core") == F.col("core"), F.lit(False))
    before_full = before & F.coalesce(F.col("p_full") == F.col("full"), F.lit(False))
    beyond_full = beyond & F.coalesce(F.col("n_full") == F.col("full"), F.lit(False))
    first_full = F.when(before, F.col("p_first_full")).otherwise(F.col("first_full"))
    last_full = F.when(beyond, F.col("n_last_full")).otherwise(F.col("last_full"))
    first_doc = F.when(before_full, F.col("p_first_doc")).otherwise(F.col("first_doc"))
    several = first_full != last_full
    if earlier:
        repeated, leads = F.col("doc") > first_doc, F.col("doc") == first_doc
    else:
        # A run cut by borders may have one entry for it in each bucket, which adds true repeats only.
        repeated, leads = F.col("twice") | before_full | beyond_full, F.lit(True)
    late = waiting.select(
        F.explode(F.array_compact(F.array(F.when(repeated, REPEATED), F.when(several & leads, DETAIL))).cast("array<tinyint>")).alias("kind"),
        "key", "start", "count",
    )
    done = compared.where(F.col("kind").isin(REPEATED, DETAIL)).select("kind", "key", "start", "count")
    return done.unionByName(late)


def _edge_order(rows: list) -> list:
    """First and last entry per bucket, buckets in order; fulls and cores compare as unsigned numbers."""
    unsigned = lambda v: v & 0xFFFFFFFFFFFFFFFF
    return sorted(rows, key=lambda r: (r["bucket"], unsigned(r["core"]), unsigned(r["full"]), r["doc"], r["start"]))


def repeated_windows(docs: DataFrame, levels: list[Generate], earlier: bool, per_kb: float, purpose: str) -> DataFrame:
    """``key, ranges`` (array of start, count) for rows with repeated windows.

    ``key`` is ``row_key("doc_id", "text")``. With ``earlier`` only windows that also start in a row of smaller doc_id
    count, and rows without doc_id neither lose nor count; else all that start at any other place. ``per_kb`` tells how many
    entries the first level makes of a thousand bytes and sizes its buckets.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("doc_id"),
        row_key("doc_id", "text").alias("key"),
        text_of().cast("binary").alias("text"),
    )
    if earlier:
        rows = docs.where("doc_id is not null").select(
            F.col("doc_id").cast("bigint").alias("doc_id"), row_key("doc_id", "text").alias("key"), text_of().cast("binary").alias("text")
        )
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    total, entries = size["n"], int((size["bytes"] or 0) / 1000 * per_kb)
    found, looked = None, rows
    for depth, generate in enumerate(levels):
        level = _level(looked, generate, earlier, entries, total, f"{purpose}_{depth}")
        done = level.where(F.col("kind") == REPEATED).select("key", "start", "count")
        found = done if found is None else found.unionByName(done)
        if depth + 1 < len(levels):
            # Rows alike in everything share a key: their ranges are the same and need one look each.
            detail = level.where(F.col("kind") == DETAIL).select("key", "start", "count").distinct()
            detail = detail.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "count"))).alias("ranges"))
            detail = written(detail, f"{purpose}_detail_{depth}")
            counted = detail.agg(F.count("*").alias("n"), F.sum(F.aggregate("ranges", F.lit(0).cast("bigint"), lambda a, r: a + r["count"]))).first()
            total, entries = counted[0], int(counted[1] or 0)
            looked = rows.join(detail, "key")
    return found.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", "count"))).alias("ranges"))
