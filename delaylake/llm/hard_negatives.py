"""Hard negatives by a secondary sort: scores packed into keys, sorted within partitions, read as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import register, table, written

CHUNK_BYTES = 64 << 20  # vectors of the anchors that one task holds
TILE_PAIRS = 1 << 33  # pairs that one task scores at most, about
ANCHORS_AT_ONCE = 512
FIRST_ROWS, MOST_ROWS = 64, 2048  # rows scored at once: few until the slots have filled
EXACT = 1 << 53  # whole numbers below are exact as doubles
LEAST, MOST = -(1 << 63), (1 << 63) - 1

POSITIVE, NEGATIVE = 0, 1

KEY_BYTES = 25  # anchor, inverted score, kind, id


def pack_keys(anchors: np.ndarray, scores: np.ndarray, kind: int, ids: np.ndarray) -> pa.Array:
    """Binary keys whose byte order is: anchor, higher score first, positives before negatives, smaller id first.

    A positive stands before negatives of the same score, so its window is open when they come.
    """

    def ordered(values: np.ndarray) -> np.ndarray:
        return values.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)

    data = np.empty((len(ids), KEY_BYTES), np.uint8)
    data[:, 0:8] = ordered(anchors).astype(">u8").view(np.uint8).reshape(-1, 8)
    data[:, 8:16] = (~ordered(scores)).astype(">u8").view(np.uint8).reshape(-1, 8)
    data[:, 16] = kind
    data[:, 17:25] = ordered(ids).astype(">u8").view(np.uint8).reshape(-1, 8)
    offsets = np.arange(len(ids) + 1, dtype=np.int32) * KEY_BYTES
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpack_keys(keys: pa.Array) -> Iterator[tuple[int, int, int, int]]:
    """``anchor, score, kind, id`` of every key."""
    data = np.frombuffer(b"".join(keys.to_pylist()), np.uint8).reshape(-1, KEY_BYTES)

    def number(at: int, invert: bool = False) -> list[int]:
        values = np.ascontiguousarray(data[:, at : at + 8]).view(">u8").ravel().astype(np.uint64)
        return ((~values if invert else values) ^ np.uint64(1 << 63)).view(np.int64).tolist()

    yield from zip(number(0), number(8, True), data[:, 16].tolist(), number(17))


class Slots:
    """The best few rows of every anchor in each of its score ranges, over rows that come in any order.

    Higher scores are better, then smaller ids. What is held per anchor does not grow with the rows.
    """

    def __init__(self, ids, labels, vectors, lows, highs, keep: int, same_label: bool):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.lows, self.highs, self.keep, self.same_label = lows, highs, keep, same_label
        self.largest = int(max(abs(int(vectors.max(initial=0))), abs(int(vectors.min(initial=0)))))
        n, ranges = lows.shape
        self.count = np.zeros((n, ranges), np.int64)
        self.score = np.zeros((n, ranges, keep), np.int64)
        self.row = np.zeros((n, ranges, keep), np.int64)

    def add(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, labels, vectors = ids[order], labels[order], vectors[order]
        largest = int(max(abs(int(vectors.max(initial=0))), abs(int(vectors.min(initial=0)))))
        # Doubles are exact below 2^53; beyond, Python's own numbers are, and scores stop at the ends of long.
        exact = max(largest, 1) * max(self.largest, 1) * max(vectors.shape[1], 1) < EXACT
        columns = vectors.T.astype(np.float64 if exact else object)
        for at in range(0, len(self.ids), ANCHORS_AT_ONCE):
            some = slice(at, at + ANCHORS_AT_ONCE)
            rows = self.vectors[some].astype(columns.dtype)
            step, start = FIRST_ROWS, 0
            while start < len(ids):
                part = slice(start, start + step)
                scores = rows @ columns[:, part]
                if not exact:
                    scores = np.clip(scores, LEAST, MOST).astype(np.int64)
                self._offer(some, scores, ids[part], labels[part])
                start, step = start + step, min(2 * step, MOST_ROWS)

    def _offer(self, some: slice, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        partner = self.labels[some, None] == labels[None, :]
        if not self.same_label:
            partner = ~partner
        partner &= self.ids[some, None] != ids[None, :]
        for r in range(self.lows.shape[1]):
            # Full slots raise the range's lower end to their last score.
            full = self.count[some, r] == self.keep
            floor = np.where(full, np.maximum(self.score[some, r, -1], self.lows[some, r]), self.lows[some, r])
            found = partner & (scores >= floor[:, None]) & (scores <= self.highs[some, r, None])
            anchor, column = np.nonzero(found)
            if not len(anchor):
                continue
            touched = np.unique(anchor)
            held = np.repeat(touched, self.count[some, r][touched])
            place = np.concatenate([np.arange(c) for c in self.count[some, r][touched]])
            anchors = np.concatenate([held, anchor])
            score = np.concatenate([self.score[some, r][held, place], scores[anchor, column].astype(np.int64)])
            row = np.concatenate([self.row[some, r][held, place], ids[column]])
            order = np.lexsort((row, ~score, anchors))
            anchors, score, row = anchors[order], score[order], row[order]
            first = np.r_[True, anchors[1:] != anchors[:-1]]
            rank = np.arange(len(anchors)) - np.maximum.accumulate(np.where(first, np.arange(len(anchors)), 0))
            best = rank < self.keep
            anchors, score, row, rank = anchors[best], score[best], row[best], rank[best]
            base = some.start
            self.score[base + anchors, r, rank] = score
            self.row[base + anchors, r, rank] = row
            self.count[base + touched, r] = np.bincount(anchors, minlength=touched[-1] + 1)[touched]

    def keys(self, kind: int) -> pa.Array:
        """A key per anchor and row held; ranges overlap, and a row held in several counts once."""
        held = np.arange(self.keep)[None, None, :] < self.count[:, :, None]
        anchors = np.broadcast_to(self.ids[:, None, None], held.shape)[held]
        scores, rows = self.score[held], self.row[held]
        order = np.lexsort((rows, anchors))
        anchors, scores, rows = anchors[order], scores[order], rows[order]
        once = np.r_[True, (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])][: len(rows)]
        return pack_keys(anchors[once], scores[once], kind, rows[once])


_KEYS = pa.schema([("key", pa.binary())])


def _arrays(batch: pa.RecordBatch, at: np.ndarray):
    """Ids, labels, vectors by length and bounds of some rows of a batch."""
    part = batch.take(pa.array(at))
    vectors = part.column("vector")
    lengths = vectors.value_lengths().to_numpy()
    for length in np.unique(lengths):
        same = np.flatnonzero(lengths == length)
        these = part.take(pa.array(same))
        values = these.column("vector").flatten().to_numpy().reshape(len(same), length)
        yield length, these, values


def _tiles(keep: int, same_label: bool, kind: int):
    """Over rows sorted by tile, anchors before others: the best rows of each anchor within the tile, as packed keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, anchors, slots = None, {}, {}

        def results() -> Iterator[pa.RecordBatch]:
            for held in slots.values():
                yield pa.RecordBatch.from_arrays([held.keys(kind)], schema=_KEYS)

        def opened(length: int) -> Slots | None:
            if length not in slots and length in anchors:
                parts = anchors.pop(length)
                ids, labels, vectors, lows, highs = (np.concatenate(p) for p in zip(*parts))
                slots[length] = Slots(ids, labels, vectors, lows, highs, keep, same_label)
            return slots.get(length)

        for batch in batches:
            tiles, is_row = batch.column("tile").to_numpy(), batch.column("kind").to_numpy()
            for this in np.unique(tiles):
                if this != tile:
                    yield from results()
                    tile, anchors, slots = this, {}, {}
                for kinds in (0, 1):
                    at = np.flatnonzero((tiles == this) & (is_row == kinds))
                    for length, part, vectors in _arrays(batch, at):
                        ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
                        if kinds == 0:
                            lows, highs = (
                                part.column(c).flatten().to_numpy().reshape(len(ids), -1) for c in ("lows", "highs")
                            )
                            anchors.setdefault(length, []).append((ids, labels, vectors, lows, highs))
                        elif (held := opened(length)) is not None:
                            held.add(ids, labels, vectors)
        yield from results()

    return run


def _scored(rows: DataFrame, anchors: DataFrame, keep: int, same_label: bool, kind: int, dimension: int, counts: tuple[int, int]) -> DataFrame:
    """Packed keys of the best rows of every anchor within its ranges, of each block of rows.

    Anchors stand in chunks, rows in blocks, both dealt by a hash of their id, and a tile is one chunk against one block. Blocks
    are as many as the session has shuffle partitions, or more where a tile would score too many pairs.
    """
    n_rows, n_anchors = counts
    chunks = max(1, -(-n_anchors * 8 * max(dimension, 1) // CHUNK_BYTES))
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-spread // chunks), -(-n_rows * -(-n_anchors // chunks) // TILE_PAIRS))
    share = lambda parts, seed: F.pmod(F.xxhash64(F.col("vec_id"), F.lit(seed)), F.lit(parts))
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    none = F.lit(None).cast("array<bigint>")
    left = anchors.withColumn("block", every(blocks)).select(
        (share(chunks, 1) * blocks + F.col("block")).cast("int").alias("tile"), F.lit(0).alias("kind"), "vec_id", "label", "vector", "lows", "highs"
    )
    right = rows.withColumn("chunk", every(chunks)).select(
        (F.col("chunk") * blocks + share(blocks, 2)).cast("int").alias("tile"), F.lit(1).alias("kind"), "vec_id", "label", "vector",
        none.alias("lows"), none.alias("highs"),
    )
    dealt = left.unionByName(right).repartitionById(chunks * blocks, F.col("tile")).sortWithinPartitions("tile", "kind")
    return dealt.mapInArrow(_tiles(keep, same_label, kind), "key binary")


def _sorted_by_key(keys: DataFrame) -> DataFrame:
    """All keys of an anchor in one partition, in the order of the keys."""
    return keys.repartition(F.substring("key", 1, 8)).sortWithinPartitions("key")


_POSITIVES = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])


def _first_positives(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, taken = None, 0
        for batch in batches:
            rows = []
            for anchor, score, _, row in unpack_keys(batch.column(0)):
                if anchor != current:
                    current, taken = anchor, 0
                if taken < most:
                    taken += 1
                    rows.append((anchor, row, score))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=_POSITIVES)

    return run


_FOUND = pa.schema(
    [("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
     ("positive_score", pa.int64()), ("negative_score", pa.int64())]
)
_FOUND_DDL = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _windows(most: int, low: int, high: int):
    """Over sorted keys: a positive opens a window, later negatives within it are emitted until it has enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, windows = None, []
        for batch in batches:
            rows = []
            for anchor, score, kind, row in unpack_keys(batch.column(0)):
                if anchor != current:
                    current, windows = anchor, []
                if kind == POSITIVE:
                    windows.append([row, score, 0])
                    continue
                for window in windows:
                    positive, best, taken = window
                    if taken < most and low * best <= 100 * score <= high * best:
                        window[2] += 1
                        rows.append((anchor, positive, taken + 1, row, best, score))
            if rows:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _FOUND)]
                yield pa.RecordBatch.from_arrays(columns, schema=_FOUND)

    return run


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """Hard negatives of every anchor and positive: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id``, a whole-number ``label`` and ``vector``, an array of whole numbers; ``is_anchor`` is a condition
    over ``vec_id``. A score is the inner product. An anchor's positives are its best ``positives`` other rows of its
    label; a positive's negatives the best ``negatives`` rows of another label whose score lies between ``low`` and ``high``
    percent of the positive's. Higher scores are better, then smaller ids.

    Two passes over tiles of anchors and rows first reduce each tile to what can be in a result: the best rows of the anchor's
    label, then, with all positives known, the best of each window. So a shuffle carries a few keys per anchor and tile,
    however many rows have one label or one vector, and nothing is left out. The keys (anchor, descending score, id) are
    dealt by anchor, sorted within partitions, and read as a stream that holds one anchor's open windows.

    Rows without an id, label or vector, or with a missing component, take no part. Of rows with one id the one with the
    least label and vector does. Vectors of different lengths have no score together. Scores beyond long stop at its ends.
    An empty table, or one without anchors, gives an empty result. Other columns are not read, whatever their names.
    """
    complete = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.struct(F.col("label").cast("bigint").alias("label"), F.col("vector").cast("array<bigint>").alias("vector")).alias("row")
    ).where(F.col("vec_id").isNotNull())
    rows = rows.select("vec_id", "row.*", "row").where(complete).groupBy("vec_id").agg(F.min("row").alias("row"))
    rows = written(rows.select("vec_id", "row.*"), "negatives_rows")
    anchors = rows.where(is_anchor)
    seen = rows.agg(F.count("*"), F.count_if(is_anchor), F.max(F.size("vector"))).first()
    counts, dimension = (seen[0], seen[1]), seen[2] or 0
    whole = {"lows": F.array(F.lit(LEAST).cast("bigint")), "highs": F.array(F.lit(MOST).cast("bigint"))}
    near = _scored(rows, anchors.withColumns(whole), positives, True, POSITIVE, dimension, counts)
    best = _sorted_by_key(near).mapInArrow(_first_positives(positives), "anchor_id bigint, positive_id bigint, positive_score bigint")
    best = written(best, "negatives_positives")

    def bound(percent: int, up: bool) -> Column:
        # Whole scores within percent of the positive's, in decimals: no bound leaves long before it is rounded.
        exact = F.col("positive_score").cast("decimal(20,0)") * F.lit(percent) / F.lit(100)
        return (F.ceil(exact) if up else F.floor(exact)).cast("decimal(38,0)").cast("bigint")

    windows = best.groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("positive_id"), bound(low, True).alias("low"), bound(high, False).alias("high")))).alias("w")
    )
    # Every anchor has the same number of ranges; a range from 1 to 0 is empty.
    filled = F.concat("w", F.array_repeat(F.struct(F.lit(0).cast("bigint").alias("positive_id"), F.lit(1).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("high")), F.lit(positives) - F.size("w")))
    windows = windows.select(F.col("anchor_id").alias("vec_id"), filled.alias("w"))
    ranged = anchors.join(windows, "vec_id").select("vec_id", "label", "vector", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    far = _scored(rows, ranged, negatives, False, NEGATIVE, dimension, counts)
    opened = best.repartition("anchor_id").mapInArrow(_packed_positives, "key binary")
    return _sorted_by_key(opened.unionByName(far)).mapInArrow(_windows(negatives, low, high), _FOUND_DDL)


def _packed_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        anchors, ids, scores = (batch.column(c).to_numpy() for c in ("anchor_id", "positive_id", "positive_score"))
        yield pa.RecordBatch.from_arrays([pack_keys(anchors, scores, POSITIVE, ids)], schema=_KEYS)


SCALE = 256  # steps per unit of a component


def scaled_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, vector``: components in whole steps; rows with a missing or non-finite component are left out."""
    vector = F.col("embedding")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    steps = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    return embeddings.where(finite).select("vec_id", "label", steps.alias("vector"))


@register("""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         list_inner_product(a.vector, r.vector)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""")
def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of every fiftieth embedding among all embeddings."""
    rows = scaled_vectors(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)
