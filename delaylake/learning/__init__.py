"""Delay models on Spark ML: split, preprocessing, model sets, metrics, promotion and scoring."""

from .scorers import Scorer, compiled
from .boosting import HistogramBoosting, HistogramBoostingModel
from .evaluation import classification_metrics, evaluate_predicted_labels, regression_metrics
from .models import (
    classifier_estimators,
    detached,
    display_name,
    preprocessing_stages,
    regressor_estimators,
    typed_features,
)
from .registry import production_version, promote, register, tag_version
from .scoring import minutes_scores, prediction_rows, score
from .split import stratified_split, with_split
from .training import train_classifiers, train_regressors

__all__ = [
    "HistogramBoosting",
    "HistogramBoostingModel",
    "Scorer",
    "classification_metrics",
    "classifier_estimators",
    "compiled",
    "detached",
    "display_name",
    "evaluate_predicted_labels",
    "minutes_scores",
    "prediction_rows",
    "preprocessing_stages",
    "production_version",
    "promote",
    "register",
    "regression_metrics",
    "regressor_estimators",
    "score",
    "stratified_split",
    "tag_version",
    "train_classifiers",
    "train_regressors",
    "typed_features",
    "with_split",
]
