"""Near copies: documents that share at least four fifths of their five-word shingles, found without loss."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import releasing
from .common import kept_rows, text_of, written
from .components import connected_components
from .simhash import majority, near_links, shingle_digests

SHINGLE = 5  # words
NUM, DEN = 4, 5  # least Jaccard similarity of two sets of shingles, as a fraction
PARITIES = 16  # least 64-bit words of a set's parity bitmap, which grows with the set
SAMPLED, OFTEN, MOST_COMMON = 64, 3, 50_000  # one text in so many shows which shingles are common; bound of their list
LEADERS = 2  # rounds in which a node is compared with one leader of its buckets, before all pairs left


def shingle_set(digests: Sequence[np.ndarray]) -> np.ndarray:
    """Sorted distinct hashes as signed numbers."""
    if not len(digests):
        return np.zeros(0, np.int64)
    return np.unique(np.concatenate(digests).view(">i8").ravel().astype(np.int64))


def least_shared(n: int) -> int:
    """A set of ``n`` shares at least so many with any set that is similar enough."""
    return -(-NUM * n // DEN)


def _prefix(found: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles in one order for all sets, common ones last: similar sets share one of these.

    ``common`` is sorted, so a set's time grows with its own size and only with the logarithm of the list's.
    """
    if not len(found):
        return found
    late = np.zeros(len(found), bool)
    if len(common):
        late = common[np.minimum(np.searchsorted(common, found), len(common) - 1)] == found
    return np.concatenate([found[~late], found[late]])[: len(found) - least_shared(len(found)) + 1]


def _parities(found: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of shingles falls on i: two bitmaps differ in no more bits than the sets in shingles.

    Two bits a shingle at least, since a bitmap that half its bits fill tells nothing; a power of two, so that it folds to a smaller one.
    """
    size = max(64 * PARITIES, 1 << (2 * len(found) - 1).bit_length() if len(found) else 0)
    places = found.view(np.uint64) % np.uint64(size)
    odd = np.bincount(places.astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in batch.column(0).to_pylist():
            found = shingle_set(list(shingle_digests(text.encode("utf-8", "replace"), SHINGLE)))
            yield pa.RecordBatch.from_arrays([pa.array(found)], names=["shingle"])


def common_shingles(docs: DataFrame) -> np.ndarray:
    """The shingles seen most often in a sample of texts, sorted; they decide the order, and so the speed, never the result."""
    texts = docs.select(text_of().alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0)
    counts = texts.mapInArrow(_sample, "shingle bigint").groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN)
    top = counts.orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).select("shingle").collect()
    return np.sort(np.array([r["shingle"] for r in top], np.int64))


_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("text_sha256", pa.string()), ("digest", pa.binary()), ("fp", pa.int64()), ("n", pa.int32()),
     ("bits", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64()))]
)
_ROWS_DDL = "doc_id bigint, text_sha256 string, digest binary, fp bigint, n int, bits array<bigint>, prefix array<bigint>"


def _hashed(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """Per row the 128-bit digest of its set and what finds its candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, sha, text in zip(*(c.to_pylist() for c in batch.columns)):
                digests = list(shingle_digests(text.encode("utf-8", "replace"), SHINGLE))
                found = shingle_set(digests)
                fp = np.uint64(majority(digests)).astype(np.int64)
                digest = xxhash.xxh3_128_digest(found.tobytes())
                rows.append((doc_id, sha, digest, fp, len(found), _parities(found), _prefix(found, common)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROWS)], schema=_ROWS)

    text = text_of()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2(text.cast("binary"), 256).alias("sha"), text.alias("text"))
    return rows.mapInArrow(run, _ROWS_DDL)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, texts = (c.to_pylist() for c in batch.columns)
        found = [shingle_set(list(shingle_digests(t.encode("utf-8", "replace"), SHINGLE))) for t in texts]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["node", "found"])


def sets_of(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, found``: the sets of these nodes (``node, text_sha256``, no text twice), made again from their texts.

    Most documents resemble none, so making the sets of the others twice costs less than keeping all.
    """
    text = text_of()
    texts = docs.select(F.sha2(text.cast("binary"), 256).alias("text_sha256"), text.alias("text"))
    texts = texts.join(nodes, "text_sha256").dropDuplicates(["text_sha256"])
    return texts.select("node", "text").mapInArrow(_sets, "node bigint, found array<bigint>")


def _sizes_fit(n: Column, m: Column) -> Column:
    return DEN * F.least(n, m) >= NUM * F.greatest(n, m)


def _enough(shared: Column, total: Column) -> Column:
    """Sets of ``total`` members together that share ``shared`` are similar enough."""
    return (NUM + DEN) * shared >= NUM * total


def _apart(x: Column, y: Column) -> Column:
    """In how many bits two parity bitmaps differ; the longer one, of twice the length, is folded first."""
    words = F.least(F.size(x), F.size(y))

    def folded(bits: Column) -> Column:
        halves = F.zip_with(F.slice(bits, F.lit(1), words), F.slice(bits, words + 1, words), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(bits) > words, halves).otherwise(bits)

    differ = F.zip_with(folded(x), folded(y), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    plain = [F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(PARITIES)]
    short = (F.size(x) == PARITIES) & (F.size(y) == PARITIES)
    return F.when(short, sum(plain[1:], plain[0])).otherwise(F.aggregate(differ, F.lit(0), lambda total, n: total + n))


def _bits_allow(x: str, y: str, total: Column) -> Column:
    """The parity bitmaps ``x`` and ``y`` of sets of fitting sizes and ``total`` members together differ in no more bits than similar
    sets may."""
    return (NUM + DEN) * _apart(F.col(x), F.col(y)) <= (DEN - NUM) * total


def allowed(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """``a, b, total`` of those pairs of nodes that sizes and parity bitmaps do not refuse; ``total`` counts the members of both sets."""
    x, y = (rows.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab")
    pairs = pairs.join(x, "a").join(y, "b")
    total = F.col("n_a") + F.col("n_b")
    may = _sizes_fit(F.col("n_a"), F.col("n_b")) & _bits_allow("bits_a", "bits_b", total)
    return pairs.where(may).select("a", "b", total.alias("total"))


def verified(left: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of nodes (``a, b, total``) whose sets are similar enough.

    ``a`` is the node that stands in many pairs, if one does: its set travels once, those of its partners twice.
    """
    x, y = (sets.select(F.col("node").alias(c), F.col("found").alias(f"found_{c}")) for c in "ab")
    x = x.join(left.select("a").distinct(), "a", "left_semi")
    shared = F.size(F.array_intersect("found_a", "found_b"))
    return left.join(y, "b").join(x, "a").where(_enough(shared, F.col("total"))).select("a", "b")


def _grid_pairs(nodes: DataFrame) -> DataFrame:
    """Nodes of equal fingerprints, and of those within two bits, by the grid of segment popcounts."""
    least = written(nodes.groupBy("fp").agg(F.min("node").alias("least")), "near_fp_nodes")
    same = nodes.join(least, "fp").select(F.col("least").alias("a"), F.col("node").alias("b"))
    a, b = (least.select(F.col("fp").alias(c), F.col("least").alias(f"least_{c}")) for c in "ab")
    pairs = same.unionByName(near_links(least).join(a, "a").join(b, "b").select(F.col("least_a").alias("a"), F.col("least_b").alias("b")))
    return pairs.where("a <> b").distinct()


def _short(n: Column, pos: Column) -> Column:
    """Of two similar sets the first shared shingle stands in the first fifth of both; in the one that is not larger it stands in
    the first ninth, since both share 4/9 of their sum, which is 8/9 of the smaller at least. Tells whether a place is in that part."""
    return pos <= n - F.ceil(2 * NUM * n / (NUM + DEN))


def _entries(nodes: DataFrame) -> DataFrame:
    """``shingle, node, n, pos, short, component``: where each node can be found, and at which place of the common order.

    Shingles of one node only, or which stand in no node's first ninth, are left out. Nearly all are, so what is counted and what is
    moved for them holds no more than that takes. Every node is a component of its own.
    """
    rows = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "shingle")).select("shingle", "node", "n", "pos")
    several = rows.select("shingle", _short(F.col("n"), F.col("pos")).alias("short")).groupBy("shingle")
    several = several.agg(F.count("*").alias("__nodes"), F.max("short").alias("__short")).where("__nodes > 1 AND __short")
    rows = rows.join(several.select("shingle").hint("merge"), "shingle", "left_semi")
    return rows.withColumn("short", _short(F.col("n"), F.col("pos"))).withColumn("component", F.col("node"))


def _can_link(x: str, y: str) -> Column:
    """Two entries of a bucket, as the first shingle that the sets share, allow them to be similar enough."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    most = F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos"))
    roles = ((n > m) | F.col(f"{x}.short")) & ((m > n) | F.col(f"{y}.short"))
    return (F.col(f"{x}.component") != F.col(f"{y}.component")) & _sizes_fit(n, m) & roles & _enough(most, n + m)


def _buckets(entries: DataFrame) -> DataFrame:
    """The entries of shingles that several components have, one of them in its first ninth."""
    several = entries.groupBy("shingle").agg(
        F.min("component").alias("__least"), F.max("component").alias("__most"), F.max("short").alias("__short")
    )
    several = several.where("__least <> __most AND __short").select("shingle")
    return entries.join(several.hint("merge"), "shingle", "left_semi")


def _with_partner(entries: DataFrame, may: Column) -> DataFrame:
    """The entries that ``may`` stand for a link with another one, ``y``, of their bucket. The first that does ends the search."""
    other = entries.alias("y").hint("merge")
    return entries.alias("x").join(other, (F.col("x.shingle") == F.col("y.shingle")) & may, "left_semi").select("x.*")


def _hopeful(entries: DataFrame, rows: DataFrame) -> DataFrame:
    """The entries that have a partner by places, sizes and bitmaps. A link has one where both of its nodes have such an entry.

    Most nodes share a shingle with some other, but few have a partner, so few sets are needed.
    """
    placed = written(_with_partner(entries, _can_link("x", "y")), "near_placed")
    told = placed.join(rows.select("node", "bits"), "node")
    return _with_partner(told, _can_link("x", "y") & _bits_met()).drop("bits")


def _bits_met() -> Column:
    return _bits_allow("x.bits", "y.bits", F.col("x.n") + F.col("y.n"))


def _leader_pairs(open_: DataFrame, seed: int) -> DataFrame:
    """Every node with that leader of its buckets which it meets most often; a bucket's leader is the least under some hash."""
    named = F.struct("node", "n", "pos", "short", "component")
    leaders = open_.groupBy("shingle").agg(F.min_by(named, F.xxhash64("node", F.lit(seed))).alias("leader"))
    met = open_.alias("x").join(leaders.select("shingle", "leader.*").hint("merge").alias("y"), "shingle").where(_can_link("x", "y"))
    times = met.groupBy(F.col("y.node").alias("a"), F.col("x.node").alias("b")).agg(F.count("*").alias("times"))
    return times.groupBy("b").agg(F.max_by("a", F.struct("times", "a")).alias("a")).select("a", "b")


def _rest_pairs(open_: DataFrame) -> DataFrame:
    """All pairs of nodes that some bucket still allows, by places, sizes and bitmaps (``bits``), before a pair is a row.

    A passage that does not make its carriers similar allows none of them, once it stands behind what is their own; variants of one
    text that have grown apart are told by their bitmaps.
    """
    may = _can_link("x", "y") & _bits_met()
    met = open_.alias("x").join(open_.alias("y").hint("merge"), "shingle").where((F.col("x.node") < F.col("y.node")) & may)
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _labels(edges: DataFrame) -> DataFrame:
    """``node, component`` after one look at the neighbours and one at theirs: nodes of one label are linked, though not all that
    are linked have one label yet. Enough to see what needs no further comparison."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    further = least.select(F.col("a").alias("least"), F.col("least").alias("component"))
    return least.join(further, "least").select(F.col("a").alias("node"), "component")


def near_copies(docs: DataFrame) -> DataFrame:
    """``doc_id, text_sha256, component`` for every row.

    Documents link when the Jaccard similarity of their sets of five-word shingles is at least 4/5; a component is what links
    reach. Sets with one 128-bit digest are one node. Sets so similar share a shingle in a prefix of each in a common order,
    so every link has a bucket where both stand, at places that allow it. Fingerprints within two bits, then one leader per node
    and round, join most of a large group first, each pair verified; then all pairs of a bucket are verified that no link has
    joined yet, so no link between components is lost and a group of mutual copies makes no pairs of all its members.

    A missing text counts as empty; texts of fewer words are one shingle, those without words equal. Repeated rows repeat in the
    result, other columns are not read, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    with releasing(spark, "near_rows", "near_components"):
        hashed = _hashed(docs, common_shingles(docs)).withColumn("node", F.monotonically_increasing_id())
        with releasing(spark, "near_digests", "near_entries", "near_rows"):  # prefixes are needed for the entries only
            rows = written(hashed, "near_prefixes")
            least = written(rows.groupBy("digest").agg(F.min("node").alias("least")), "near_digests")
            nodes = rows.join(least.select(F.col("least").alias("node")), "node", "left_semi")
            entries = written(_entries(nodes.select("node", "n", "prefix")), "near_entries")
            rows = written(rows.drop("prefix"), "near_rows")
        equal = rows.select("digest", F.col("node").alias("b")).join(least, "digest").where("least <> b")
        nodes = rows.join(least.select(F.col("least").alias("node")), "node", "left_semi")
        with releasing(spark, "near_hopeful"):
            entries = written(_hopeful(entries, rows), "near_hopeful")
        with releasing(spark, "near_candidates", "near_tried"):
            tried = written(_grid_pairs(nodes.select("node", "fp")), "near_tried")
            pairs = written(allowed(tried, rows), "near_candidates")
        found = entries.select("node").unionByName(pairs.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
        found = written(rows.select("node", "text_sha256").join(found, "node", "left_semi"), "near_wanted")
        sets = written(sets_of(found, docs), "near_sets")
        edges = written(verified(pairs, sets), "near_edges")
        open_ = entries
        for seed in range(LEADERS + 1):
            last = seed == LEADERS
            joined = written(connected_components(edges) if last else _labels(edges), "near_joined")
            placed = open_.drop("component").join(joined, "node", "left")
            open_ = written(_buckets(placed.withColumn("component", F.coalesce("component", "node"))), "near_open")
            pairs = _rest_pairs(open_.join(rows.select("node", "bits"), "node")) if last else _leader_pairs(open_, seed)
            known = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
            pairs = written(pairs.join(known, ["a", "b"], "left_anti"), "near_pairs")
            left = written(allowed(pairs, rows), "near_candidates")
            edges = edges.unionByName(written(verified(left, sets), "near_edges"))
            tried = tried.unionByName(pairs)
        edges = edges.unionByName(equal.select(F.col("least").alias("a"), "b"))
        named = written(connected_components(edges), "near_components")
    narrow = rows.select("doc_id", "text_sha256", "node")
    return narrow.join(named, "node", "left").select("doc_id", "text_sha256", F.coalesce("component", "node").alias("component"))


def without_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of their component, each once, with all their columns.

    Of a component without any doc_id one row stays.
    """
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_sha256")
    one = near_copies(docs).groupBy("component").agg(F.min(order).alias("one"))
    return kept_rows(docs, one.select("one.doc_id", "one.text_sha256"))
