"""Connected components of a graph given as edges, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``, of one orderable type); the component is its least node.

    Every round replaces edges by edges to smaller nodes: a large star links a node's larger neighbours, a
    small star its smaller ones, to the least. The result is a star per component after a number of rounds that
    grows with the logarithm of the graph's size. Least neighbours come from partial aggregates and a join,
    so a node with a third of all edges is no single group; each round is a table in the shared folder.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        stars = edges
        for large in (True, False):
            both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else stars
            least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
            linked = both.join(least, "a")
            if large:  # neighbours larger than the node
                linked = linked.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
            else:  # the node itself and its smaller neighbours
                linked = linked.select("b", "least").unionByName(least.select(F.col("a").alias("b"), "least"))
                linked = linked.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
            stars = linked.distinct() if large else written(linked.distinct(), "edges")
        edges = stars
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if before == tuple(state):
            break
        before = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
