"""Preprocessing and the model sets (M2, M3, M4, M6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType

from ..constants import MODEL_DISPLAY_NAMES, SEED
from ..session import shared_folder
from .boosting import HistogramBoosting

try:  # optional package
    from xgboost.spark import SparkXGBClassifier, SparkXGBRegressor
except ImportError:
    SparkXGBClassifier = SparkXGBRegressor = None


def typed_features(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """Text features are categorical, all others numeric."""
    categorical = [f for f in features if isinstance(df.schema[f].dataType, StringType)]
    return categorical, [f for f in features if f not in categorical]


def preprocessing_stages(
    categorical: Sequence[str], numeric: Sequence[str], output: str = "features"
) -> list[Estimator | Transformer]:
    """One-hot categories and standardised numbers.

    Values unseen in training, and NULL, become the all-zero vector; NULL numbers become the training
    mean, so every row gets a score. The scaler divides by the sample deviation.
    """
    casts = [f"CAST({c} AS STRING) AS {c}_text" for c in categorical]
    casts += [f"CAST({c} AS DOUBLE) AS {c}_number" for c in numeric]
    stages: list[Estimator | Transformer] = [SQLTransformer(statement=f"SELECT *, {', '.join(casts)} FROM __THIS__")]
    inputs = []
    if categorical:
        stages += [
            StringIndexer(
                inputCols=[f"{c}_text" for c in categorical],
                outputCols=[f"{c}_index" for c in categorical],
                handleInvalid="keep",
            ),
            OneHotEncoder(
                inputCols=[f"{c}_index" for c in categorical],
                outputCols=[f"{c}_onehot" for c in categorical],
                dropLast=True,
            ),
        ]
        inputs += [f"{c}_onehot" for c in categorical]
    if numeric:
        filled = [f"{c}_filled" for c in numeric]
        stages += [
            Imputer(inputCols=[f"{c}_number" for c in numeric], outputCols=filled, strategy="mean"),
            VectorAssembler(inputCols=filled, outputCol="numbers"),
            StandardScaler(inputCol="numbers", outputCol="scaled_numbers", withMean=True, withStd=True),
        ]
        inputs.append("scaled_numbers")
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output))
    return stages


def classifier_estimators(label: str = "label", trees: int = 100, forest_depth: int = 10) -> dict[str, Estimator]:
    """The four classifiers; without the optional boosting package the library's own second-order trees stand in.

    ``forest_depth`` bounds the size of each tree of a forest; Spark allows 30 levels, and memory doubles with each.
    """
    boosted = (
        SparkXGBClassifier(label_col=label, features_col="features")
        if SparkXGBClassifier
        else HistogramBoosting("binary", labelCol=label, rounds=trees)
    )
    return {
        "RandomForest": RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=forest_depth, seed=SEED),
        "LogisticRegression": LogisticRegression(labelCol=label, maxIter=500),
        "XGBoost": boosted,
        "GradientBoosting": GBTClassifier(labelCol=label, maxIter=trees, maxDepth=3, seed=SEED),
    }


def regressor_estimators(label: str = "label", trees: int = 100, forest_depth: int = 10) -> dict[str, Estimator]:
    """The four regressors, with the same parameters."""
    boosted = (
        SparkXGBRegressor(label_col=label, features_col="features", n_estimators=trees)
        if SparkXGBRegressor
        else HistogramBoosting("squared", labelCol=label, rounds=trees)
    )
    return {
        "LinearRegression": LinearRegression(labelCol=label),
        "RandomForestRegressor": RandomForestRegressor(labelCol=label, numTrees=trees, maxDepth=forest_depth, seed=SEED),
        "GradientBoostingRegressor": GBTRegressor(labelCol=label, maxIter=trees, maxDepth=3, seed=SEED),
        "XGBRegressor": boosted,
    }


def detached(spark: SparkSession, model: Model) -> Model:
    """The model read back from the shared folder.

    A freshly fitted model holds its training summary, and with it the session, which cannot travel to
    the executors once the session has observed metrics.
    """
    if isinstance(model, PipelineModel):
        return PipelineModel([*model.stages[:-1], detached(spark, model.stages[-1])])
    path = shared_folder(spark, "model")
    model.write().save(path)
    return type(model).load(path)


def display_name(class_name: str, names: Mapping[str, str] = MODEL_DISPLAY_NAMES) -> str:
    """Class name without its kind, shown under its usual name."""
    short = class_name.replace("Classifier", "").replace("Regressor", "")
    return names.get(short, short)
