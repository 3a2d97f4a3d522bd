"""Metrics as single aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratio


def classification_metrics(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, recall, precision and F1 of the positive class; 0 where a denominator is 0."""
    actual, guess = F.col(label).cast("int") == 1, F.col(prediction).cast("int") == 1
    counts = df.groupBy(*by).agg(
        F.count_if(actual & guess).alias("tp"),
        F.count_if(~actual & guess).alias("fp"),
        F.count_if(actual & ~guess).alias("fn"),
        F.count_if(~actual & ~guess).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by,
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def evaluate_predicted_labels(flights: DataFrame) -> DataFrame:
    """Live quality: outcomes against the reconciled predictions of the same flights."""
    known = flights.filter(F.col("is_delayed").isNotNull() & F.col("is_delayed_predicted").isNotNull())
    return classification_metrics(known, "is_delayed", "is_delayed_predicted")


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R2 in one pass: the total sum of squares is n times the population variance.

    Only rows with both values count. A constant target gives 1 when predicted exactly, else 0.
    """
    error = F.col(label) - F.col(prediction)
    sums = df.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(F.when(error.isNotNull(), F.col(label))).alias("variance"),
    )
    return sums.select(
        *by,
        "mae",
        F.sqrt("mse").alias("rmse"),
        F.when(F.col("variance") > 0, 1 - F.col("mse") / F.col("variance"))
        .when(F.col("mse") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
        .alias("r2"),
    )
