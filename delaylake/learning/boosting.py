"""Second-order boosted trees from histograms: the fourth model of both sets (M4, M6)."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .trees import Split, node_from, node_plain

UNITS = 1 << 20  # gradients are summed as whole numbers of this part, so their sums do not depend on the order of rows
DIRECT = 64  # so many tasks' sums are added by the driver, those of more tasks are combined by key before
FOLD = 10  # trees evaluated per row before their sum is written with the rows
LEAST_GAIN = 1e-6


class _Boosted(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Names of columns, and what is learnt."""

    objective = Param(Params._dummy(), "objective", "binary or squared", TypeConverters.toString)


class HistogramBoosting(Estimator, _Boosted, DefaultParamsReadable, DefaultParamsWritable):
    """Trees grown level by level, each on the gradients and hessians of the loss at what the trees before it say.

    Features become bins once, between quantiles. A level of a tree is one pass: sums of gradients and hessians per
    node, feature and bin, made in every task from whole columns. What reaches the driver is bounded by nodes, features and bins,
    whatever the rows; it picks the splits of greatest gain, ``GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)``, of equal ones that of
    the first feature and least limit. A leaf says ``-G/(H+l)`` times the step. Rows without label take no part.

    ``objective`` is ``binary`` (labels 0 and 1, logistic loss) or ``squared``.
    """

    rounds = Param(Params._dummy(), "rounds", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of a leaf that counts", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins per feature", TypeConverters.toInt)
    regularisation = Param(Params._dummy(), "regularisation", "added to sums of hessians", TypeConverters.toFloat)
    leastWeight = Param(Params._dummy(), "leastWeight", "least sum of hessians in a leaf", TypeConverters.toFloat)

    def __init__(self, objective: str = "binary", labelCol: str = "label", featuresCol: str = "features", **params):
        super().__init__()
        defaults = {"rounds": 100, "maxDepth": 3, "stepSize": 0.3, "maxBins": 32, "regularisation": 1.0, "leastWeight": 1.0}
        given = {**defaults, **params, "objective": objective, "labelCol": labelCol, "featuresCol": featuresCol}
        self._set(**given, predictionCol="prediction")

    def _cuts(self, rows: DataFrame, features: int) -> list[list[float]]:
        """Limits between bins per feature: its quantiles, once each; the largest value has nothing above it."""
        bins = self.getOrDefault("maxBins")
        shares = [i / bins for i in range(bins + 1)]
        found = rows.agg(*[F.percentile_approx(F.col("x")[i], shares, 100 * bins).alias(f"c{i}") for i in range(features)]).first()
        return [sorted(set(c))[:-1] if c else [] for c in found]

    def _fit(self, dataset: DataFrame) -> HistogramBoostingModel:
        binary = self.getOrDefault("objective") == "binary"
        label = F.col(self.getLabelCol()).cast("double")
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), label.alias("y")).where("y IS NOT NULL")
        first = rows.first()
        if first is None:
            raise ValueError("no labelled row to learn from")
        cuts = self._cuts(rows, len(first.x))
        mean = rows.agg(F.avg("y")).first()[0]
        share = min(max(mean, 1e-6), 1 - 1e-6)
        base = math.log(share / (1 - share)) if binary else mean
        bins = [reduce(add, [(F.col("x")[i] > c).cast("int") for c in limits], F.lit(0)) for i, limits in enumerate(cuts)]
        rows = rows.select("y", F.array(*bins).alias("bins"), F.lit(base).cast("double").alias("margin"))
        cores = dataset.sparkSession.sparkContext.defaultParallelism
        if rows.rdd.getNumPartitions() < cores:  # sums do not depend on which task has a row
            rows = rows.repartition(cores)
        rows = written(rows, "boosting")
        direct = rows.rdd.getNumPartitions() <= DIRECT
        trees, pending = [], []
        for _ in range(self.getOrDefault("rounds")):
            if len(pending) == FOLD:
                margin = reduce(add, [_on_bins(t, cuts) for t in pending], F.col("margin"))
                rows, pending = written(rows.withColumn("margin", margin), "boosting"), []
            tree = self._grow(rows, pending, cuts, binary, direct)
            if not isinstance(tree, Split):
                break  # nothing is left to gain, and no later tree would see anything else
            trees.append(tree)
            pending.append(tree)
        model = HistogramBoostingModel()
        model._set(
            objective=self.getOrDefault("objective"), featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(),
            predictionCol=self.getPredictionCol(), ensemble=json.dumps({"base": base, "trees": [node_plain(t) for t in trees]}),
        )
        return model

    def _grow(self, rows: DataFrame, pending: list[Split], cuts: list[list[float]], binary: bool, direct: bool) -> Split | float:
        width = 1 + max(map(len, cuts))
        said = [_binned(t, cuts) for t in pending]
        least, extra, step = (self.getOrDefault(p) for p in ("leastWeight", "regularisation", "stepSize"))

        def leaf(g: int, h: int) -> float:
            return -step * g / (h + extra * UNITS)

        def score(g: int, h: int) -> float:
            return g * g / UNITS / (h + extra * UNITS)

        splits: dict[int, tuple[int, int]] = {}  # node -> feature and last bin to the left; node n has 2n + 1 and 2n + 2
        values: dict[int, float] = {}
        open_ = [0]
        for _ in range(self.getOrDefault("maxDepth")):
            sums = rows.mapInArrow(_histograms(splits, open_, said, binary, len(cuts), width), "slot bigint, g bigint, h bigint")
            if not direct:
                sums = sums.groupBy("slot").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            totals: dict[int, tuple[int, int]] = {}
            for slot, g, h in zip(*(c.to_pylist() for c in sums.toArrow().columns)):
                before = totals.get(slot, (0, 0))
                totals[slot] = (before[0] + g, before[1] + h)
            found: dict[int, dict[int, list]] = {}
            for slot, (g, h) in totals.items():
                place, bin_ = divmod(slot, width)
                found.setdefault(open_[place // len(cuts)], {}).setdefault(place % len(cuts), []).append((bin_, g, h))
            following = []
            for at in sorted(found):
                total_g, total_h = (sum(b[i] for b in found[at][0]) for i in (1, 2))
                values[at] = leaf(total_g, total_h)
                best = (LEAST_GAIN, None)
                for feature in sorted(found[at]):
                    g = h = 0
                    for bin_, bin_g, bin_h in sorted(found[at][feature]):
                        g, h = g + bin_g, h + bin_h
                        if h < least * UNITS or total_h - h < least * UNITS:
                            continue
                        gain = score(g, h) + score(total_g - g, total_h - h) - score(total_g, total_h)
                        if gain > best[0]:
                            best = (gain, (feature, bin_, g, h))
                if best[1] is not None:
                    feature, bin_, g, h = best[1]
                    splits[at] = (feature, bin_)
                    values[2 * at + 1], values[2 * at + 2] = leaf(g, h), leaf(total_g - g, total_h - h)
                    following += [2 * at + 1, 2 * at + 2]
            open_ = following
            if not open_:
                break

        def built(at: int) -> Split | float:
            if at not in splits:
                return values.get(at, 0.0)
            feature, bin_ = splits[at]
            return Split(feature, cuts[feature][bin_], built(2 * at + 1), built(2 * at + 2))

        return built(0)


def _binned(node: Split | float, cuts: list[list[float]]) -> tuple | float:
    """A tree as feature, last bin to the left and branches."""
    if not isinstance(node, Split):
        return float(node)
    return node.feature, cuts[node.feature].index(node.limit), _binned(node.left, cuts), _binned(node.right, cuts)


def _histograms(
    splits: dict[int, tuple[int, int]], open_: list[int], trees: list, binary: bool, features: int, width: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What sums a task's gradients and hessians, as whole numbers, per slot: open node, feature and bin that have rows.

    All of it is inside, so that a worker needs no module of this library.
    """

    def said(tree, bins):
        if not isinstance(tree, tuple):
            return tree
        feature, at, left, right = tree
        return np.where(bins[:, feature] <= at, said(left, bins), said(right, bins))

    def reached(at, bins):
        if at not in splits:
            return open_.index(at) if at in open_ else -1
        feature, last = splits[at]
        return np.where(bins[:, feature] <= last, reached(2 * at + 1, bins), reached(2 * at + 2, bins))

    def whole(value):  # halves away from zero
        value = value * UNITS
        if not np.abs(value).sum() < 2.0**62:  # also when it is no number
            raise OverflowError("gradients do not fit 64 bits")
        down = np.trunc(value)
        return (down + np.sign(value) * (np.abs(value - down) >= 0.5)).astype(np.int64)

    def run(batches):
        g, h, rows = (np.zeros(len(open_) * features * width, np.int64) for _ in range(3))
        for batch in batches:
            if not batch.num_rows:
                continue
            y, margin = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "margin"))
            bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(-1, features)
            for tree in trees:
                margin = margin + said(tree, bins)
            if binary:
                with np.errstate(over="ignore"):
                    chance = 1 / (1 + np.exp(-margin))
                slope, bend = chance - y, np.maximum(chance * (1 - chance), 1e-16)
            else:
                slope, bend = margin - y, np.ones(len(y))
            slope, bend = whole(slope), whole(bend)
            node = np.broadcast_to(reached(0, bins), len(y))
            kept = node >= 0
            node, slope, bend, bins = node[kept].astype(np.int64), slope[kept], bend[kept], bins[kept]
            for feature in range(features):
                slot = (node * features + feature) * width + bins[:, feature]
                np.add.at(g, slot, slope)
                np.add.at(h, slot, bend)
                np.add.at(rows, slot, 1)
        slots = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(g[slots]), pa.array(h[slots])], names=["slot", "g", "h"])

    return run


def _on_bins(node: Split | float, cuts: list[list[float]]) -> Column:
    """What a tree says of a row of bins."""
    if not isinstance(node, Split):
        return F.lit(float(node))
    at = cuts[node.feature].index(node.limit)
    return F.when(F.col("bins")[node.feature] <= at, _on_bins(node.left, cuts)).otherwise(_on_bins(node.right, cuts))


def _on_values(node: Split | float, x: Column) -> Column:
    if not isinstance(node, Split):
        return F.lit(float(node))
    return F.when(x[node.feature] <= node.limit, _on_values(node.left, x)).otherwise(_on_values(node.right, x))


class HistogramBoostingModel(Model, _Boosted, DefaultParamsReadable, DefaultParamsWritable):
    """The trees that were grown; a prediction is one expression over the feature vector's values."""

    ensemble = Param(Params._dummy(), "ensemble", "first value and trees, as JSON", TypeConverters.toString)

    @property
    def base(self) -> float:
        return json.loads(self.getOrDefault("ensemble"))["base"]

    @property
    def trees(self) -> list[Split | float]:
        return [node_from(t) for t in json.loads(self.getOrDefault("ensemble"))["trees"]]

    @property
    def binary(self) -> bool:
        return self.getOrDefault("objective") == "binary"

    def margin(self, x: Column) -> Column:
        return reduce(add, [_on_values(t, x) for t in self.trees], F.lit(self.base))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        margin = self.margin(vector_to_array(self.getFeaturesCol()))
        return dataset.withColumn(self.getPredictionCol(), (margin > 0).cast("double") if self.binary else margin)
