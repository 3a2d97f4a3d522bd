"""SimHash near-duplicates: segment popcounts as a grid under Manhattan distance, then exact verification."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_rows, register, row_key, table, text_of, written
from .components import connected_components

BITS, SEGMENT = 64, 2  # a fingerprint's bits, bits per segment: so few that unrelated ones rarely share a cell
SHINGLE, SEED = 3, 42
CHUNK = 1 << 16  # shingles counted at once


def shingle_digests(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """The XXH64 of each shingle of words, in order, as rows of eight bytes, in chunks; nothing without words.

    Words are split at ASCII white space and lower-cased in A-Z, which is what ``bytes`` does.
    """
    words = text.lower().split()
    if not words:
        return
    plain = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    first, last = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_digest
    for at in range(0, len(first), CHUNK):
        hashes = b"".join([digest(plain[a:b], SEED) for a, b in zip(first[at : at + CHUNK], last[at : at + CHUNK])])
        yield np.frombuffer(hashes, np.uint8).reshape(-1, 8)


def majority(digests: Iterable[np.ndarray]) -> int:
    """Bit i is one when it is set in over half of the hashes; none give zero."""
    ones, count = np.zeros(BITS, np.int64), 0
    for part in digests:
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
        count += len(part)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The majority of the shingles' hashes, bit by bit; no words give zero."""
    return majority(shingle_digests(text, shingle))


_SIGNED = 1 << 63
_OUT = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("fp", pa.int64())])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_key, fp`` for every row; ``fp`` holds the 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts = batch.columns
            fps = [fingerprint((t or "").encode("utf-8", "replace"), shingle) for t in texts.to_pylist()]
            fps = [f - (f >= _SIGNED) * 2 * _SIGNED for f in fps]
            yield pa.RecordBatch.from_arrays([ids, keys, pa.array(fps, pa.int64())], schema=_OUT)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key("doc_id", "text").alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id bigint, text_key bigint, fp bigint")


def _cells(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint's popcount vector and the vectors one step from it, coded to one number; with the row."""
    segments = BITS // SEGMENT
    shifts = np.arange(segments, dtype=np.uint64) * np.uint64(SEGMENT)
    parts = (fps[:, None] >> shifts) & np.uint64((1 << SEGMENT) - 1)
    counts = np.array([bin(i).count("1") for i in range(1 << SEGMENT)], np.uint64)[parts]
    width = np.uint64(max(1, SEGMENT.bit_length()))
    place = np.arange(segments, dtype=np.uint64) * width
    code = (counts << place).sum(1, dtype=np.uint64)
    up = code[:, None] + (np.uint64(1) << place)
    down = code[:, None] - (np.uint64(1) << place)
    rows = np.arange(len(fps))
    up_ok, down_ok = counts < SEGMENT, counts > 0
    owner = np.concatenate([rows, np.nonzero(up_ok)[0], np.nonzero(down_ok)[0]])
    return np.concatenate([code, up[up_ok], down[down_ok]]), owner


def _flips(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint and all values one bit from it, with the row."""
    masks = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(BITS, dtype=np.uint64)])
    return (fps[:, None] ^ masks).ravel(), np.repeat(np.arange(len(fps)), len(masks))


def _spread(fps: DataFrame, around, name: str) -> DataFrame:
    """``name, fp``: every fingerprint at each of its places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for at in range(0, len(values), 4096):
                part = values[at : at + 4096]
                place, owner = around(part)
                columns = [pa.array(place.view(np.int64)), pa.array(part[owner].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=[name, "fp"])

    return fps.select("fp").mapInArrow(run, f"{name} bigint, fp bigint")


def near_links(fps: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect exactly the fingerprints (distinct ``fp``) within two bits of each other.

    Two fingerprints' bits differ at least as much as their vectors of segment popcounts do in Manhattan distance. So both of
    a pair within two bits stand in the cell of some vector at most one step from either: each is entered in the cells
    of its own vector and of those one step away, and those that share no cell are done. The rest is verified exactly: two values
    are within two bits if and only if some value is within one bit of both, so all that meet at such a value are
    linked, each to the least there. Rows grow with the number of fingerprints, also where many are near each other.
    """
    cells = _spread(fps, _cells, "cell")
    shared = cells.groupBy("cell").agg(F.min("fp").alias("__least"), F.max("fp").alias("__most")).where("__least <> __most")
    shared = shared.select("cell").hint("merge")  # its size has no bound, so it is never broadcast
    near = written(cells.join(shared, "cell", "left_semi").select("fp").distinct(), "near_fps")
    meet = _spread(near, _flips, "middle")
    least = meet.groupBy("middle").agg(F.min("fp").alias("a"), F.max("fp").alias("__most")).where("a <> __most")
    return meet.join(least.select("middle", "a").hint("merge"), "middle").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id, text_key`` for every row.

    Documents link when their fingerprints differ in at most two bits; the component is the least doc_id reachable.
    Texts that are missing, empty or without words have fingerprint zero and link like any other. Equal fingerprints are one node, so
    copies add no edges. A missing doc_id is never the least unless its whole component has none. Repeated rows repeat in the
    result; other columns are not read; an empty table gives an empty result.
    """
    rows = written(fingerprints(docs, shingle), "fingerprints")
    per_fp = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    per_fp = written(per_fp, "distinct_fps")
    components = connected_components(near_links(per_fp))
    named = per_fp.join(components, per_fp["fp"] == components["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    named = written(named, "fp_components")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "component").select("fp", "component_id")
    return rows.join(ids, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "text_key"
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of their group, each once, with all their columns.

    Of a group without any doc_id one row stays.
    """
    sha = F.sha2(text_of().cast("binary"), 256)
    texts = docs.select("doc_id", row_key("doc_id", "text").alias("text_key"), sha.alias("text_sha256")).distinct()
    found = near_duplicates(docs).where("doc_id <=> component_id")
    rows = found.join(texts.drop("doc_id"), "text_key")
    one = rows.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("of")).agg(
        F.first("doc_id").alias("doc_id"), F.min("text_sha256").alias("text_sha256")
    )
    return kept_rows(docs, one)


@register()
def op1_simhash_near_dedup(spark, sf_dir):
    """Near-duplicate groups of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")
