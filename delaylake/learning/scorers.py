"""A fitted pipeline as one expression: scoring without vectors, inside code generation, and as SQL."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, GBTClassificationModel, LogisticRegressionModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import ImputerModel, OneHotEncoderModel, StandardScalerModel, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, LinearRegressionModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import HistogramBoostingModel
from .trees import Split, node_from, node_plain, splits_in

MOST_NODES = 4_000  # splits of all trees together; larger ensembles are scored by the pipeline itself


@dataclass(frozen=True)
class Category:
    """A text column: 1 where it equals ``value``, else 0; NULL equals nothing."""

    column: str
    value: str


@dataclass(frozen=True)
class Number:
    """A numeric column: ``(x - mean) * factor``, a missing x counting as ``missing``."""

    column: str
    missing: float
    mean: float
    factor: float


@dataclass(frozen=True)
class Scorer:
    """Features in order, and what is made of them.

    The score is ``base`` plus the sum of ``weights`` times features, plus the sum of ``trees`` (each already weighted). A
    classifier says yes where the score is above ``threshold``.
    """

    features: tuple[Category | Number, ...]
    base: float = 0.0
    weights: tuple[float, ...] = ()
    trees: tuple[Split | float, ...] = ()
    threshold: float | None = None
    columns: tuple[str, ...] = field(init=False, compare=False, default=())

    def __post_init__(self) -> None:
        object.__setattr__(self, "columns", tuple(dict.fromkeys(f.column for f in self.features)))

    # -- as SQL -----------------------------------------------------------------------------------

    def _terms(self) -> list[str]:
        """Every term as SQL that Spark and other engines read alike; categories of a column share one CASE."""
        terms = [_number(self.base)]
        cases: dict[str, list[str]] = {}
        for feature, weight in zip(self.features, self.weights):
            if isinstance(feature, Category):
                cases.setdefault(feature.column, []).append(f"WHEN {_text(feature.value)} THEN {_number(weight)}")
            elif weight:
                terms.append(f"{_number(weight)} * {_scaled(feature)}")
        terms += [f"CASE CAST({c} AS VARCHAR(200)) {' '.join(whens)} ELSE {_number(0.0)} END" for c, whens in cases.items()]
        return terms + [self._branch(tree) for tree in self.trees]

    def _branch(self, node: Split | float) -> str:
        if not isinstance(node, Split):
            return _number(node)
        feature = self.features[node.feature]
        if isinstance(feature, Category):
            # 0 or 1 against the limit: which values go left is known before any row is seen.
            zero, one = node.limit >= 0, node.limit >= 1
            if zero == one:
                return self._branch(node.left if zero else node.right)
            test = f"CAST({feature.column} AS VARCHAR(200)) = {_text(feature.value)}"
            return f"CASE WHEN {test} THEN {self._branch(node.right)} ELSE {self._branch(node.left)} END"
        test = f"{_scaled(feature)} <= {_number(node.limit)}"
        return f"CASE WHEN {test} THEN {self._branch(node.left)} ELSE {self._branch(node.right)} END"

    def score_sql(self) -> str:
        """The score as an SQL expression over the feature columns."""
        return " + ".join(f"({t})" for t in self._terms())

    def prediction_sql(self) -> str:
        """The score, or for a classifier whether it is above the threshold."""
        return self.score_sql() if self.threshold is None else f"({self.score_sql()}) > {_number(self.threshold)}"

    def column(self) -> Column:
        """``prediction_sql`` as a column."""
        return F.expr(self.prediction_sql().replace("VARCHAR(200)", "STRING"))

    # -- stored -----------------------------------------------------------------------------------

    def to_json(self) -> str:
        return json.dumps(
            {
                "features": [asdict(f) for f in self.features],
                "base": self.base,
                "weights": self.weights,
                "trees": [node_plain(t) for t in self.trees],
                "threshold": self.threshold,
            }
        )

    @classmethod
    def from_json(cls, text: str) -> Scorer:
        data = json.loads(text)
        features = tuple(Category(**f) if "value" in f else Number(**f) for f in data["features"])
        return cls(features, data["base"], tuple(data["weights"]), tuple(node_from(t) for t in data["trees"]), data["threshold"])


def _number(value: float) -> str:
    return f"CAST({float(value)!r} AS DOUBLE)"


def _text(value: str) -> str:
    if "\\" in value:
        raise NotImplementedError("a category with a backslash has no spelling that all engines share")
    return "'" + value.replace("'", "''") + "'"


def _scaled(feature: Number) -> str:
    found = f"nullif(CAST({feature.column} AS DOUBLE), CAST('NaN' AS DOUBLE))"
    return f"((coalesce({found}, {_number(feature.missing)}) - {_number(feature.mean)}) * {_number(feature.factor)})"


def _tree(node) -> Split | float:
    """A node of Spark's tree. One-hot features split by value, 0 on one side and 1 on the other."""
    if node.numDescendants() == 0:
        return float(node.prediction())
    split, left, right = node.split(), _tree(node.leftChild()), _tree(node.rightChild())
    if split.getClass().getSimpleName() == "ContinuousSplit":
        return Split(split.featureIndex(), split.threshold(), left, right)
    if 0.0 not in list(split.leftCategories()):
        left, right = right, left
    return Split(split.featureIndex(), 0.0, left, right)


def _weighted(node: Split | float, by: float) -> Split | float:
    if isinstance(node, Split):
        return Split(node.feature, node.limit, _weighted(node.left, by), _weighted(node.right, by))
    return node * by


def _features(stages: Sequence) -> tuple[Category | Number, ...]:
    """The features of ``preprocessing_stages``, in the order of its last vector."""
    groups: dict[str, list[Category | Number]] = {}
    labels: dict[str, list[str]] = {}
    filled: dict[str, tuple[str, float]] = {}
    for stage in stages:
        if isinstance(stage, StringIndexerModel):
            labels |= dict(zip(stage.getOutputCols(), stage.labelsArray))
        elif isinstance(stage, OneHotEncoderModel):
            if not stage.getDropLast():
                raise NotImplementedError("one-hot vectors with a place for unseen values")
            for name, out in zip(stage.getInputCols(), stage.getOutputCols()):
                column = name.removesuffix("_index")
                groups[out] = [Category(column, value) for value in labels[name]]
        elif isinstance(stage, ImputerModel):
            means = stage.surrogateDF.first().asDict()
            for name, out in zip(stage.getInputCols(), stage.getOutputCols()):
                filled[out] = (name.removesuffix("_number"), float(means[name]))
        elif isinstance(stage, VectorAssembler) and stage.getOutputCol() == "numbers":
            groups["numbers"] = [Number(*filled[c], 0.0, 1.0) for c in stage.getInputCols()]
        elif isinstance(stage, StandardScalerModel):
            scaled = zip(groups["numbers"], stage.mean.toArray().tolist(), stage.std.toArray().tolist())
            # As the scaler has it: a column without spread becomes zero.
            groups[stage.getOutputCol()] = [Number(f.column, f.missing, mean, 1 / dev if dev else 0.0) for f, mean, dev in scaled]
        elif isinstance(stage, VectorAssembler):
            return tuple(f for name in stage.getInputCols() for f in groups[name])
    raise NotImplementedError("stages without a vector of features")


def compiled(model: PipelineModel) -> Scorer | None:
    """The scorer that predicts what ``model`` does; None for a model that has no such form or too many splits.

    Forests of classifiers vote with their leaves' class shares, boosted ones add their trees' weighted values.
    """
    *stages, last = model.stages
    try:
        features = _features(stages)
        if isinstance(last, LogisticRegressionModel):
            if last.numClasses != 2:
                return None
            threshold = last.getThreshold()
            limit = math.inf if threshold >= 1 else -math.inf if threshold <= 0 else math.log(threshold / (1 - threshold))
            return Scorer(features, last.intercept, tuple(last.coefficients.toArray().tolist()), threshold=limit) if math.isfinite(limit) else None
        if isinstance(last, LinearRegressionModel):
            return Scorer(features, last.intercept, tuple(last.coefficients.toArray().tolist()))
        if isinstance(last, (RandomForestClassificationModel, DecisionTreeClassificationModel)):
            return None  # their leaves hold counts of classes, which the public interface does not give
        if isinstance(last, HistogramBoostingModel):
            if sum(map(splits_in, last.trees)) > MOST_NODES:
                return None
            return Scorer(features, last.base, trees=tuple(last.trees), threshold=0.0 if last.binary else None)
        if isinstance(last, DecisionTreeRegressionModel):
            trees, weights = [last], [1.0]
        elif isinstance(last, RandomForestRegressionModel):
            trees, weights = last.trees, [1 / last.getNumTrees] * last.getNumTrees
        elif isinstance(last, (GBTClassificationModel, GBTRegressionModel)):
            trees, weights = last.trees, list(last.treeWeights)
        else:
            return None
        if sum(tree.numNodes // 2 for tree in trees) > MOST_NODES:
            return None
        nodes = tuple(_weighted(_tree(tree._call_java("rootNode")), weight) for tree, weight in zip(trees, weights))
        return Scorer(features, trees=nodes, threshold=0.0 if isinstance(last, GBTClassificationModel) else None)
    except NotImplementedError:
        return None


def predicted(df: DataFrame, model: PipelineModel, output: str) -> DataFrame:
    """``df`` with the model's prediction: one expression where the model has that form, else through its stages.

    A classifier's is boolean, a regressor's a number.
    """
    scorer = compiled(model)
    if scorer is not None:
        return df.withColumn(output, scorer.column())
    found = F.col("prediction")
    last = model.stages[-1]
    classifier = last.binary if isinstance(last, HistogramBoostingModel) else hasattr(last, "numClasses")
    return model.transform(df).select(*[F.col(f"`{c}`") for c in df.columns], (found == 1.0 if classifier else found).alias(output))
