"""Outcome reconciliation and minute updates as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(flights: DataFrame, predictions: DataFrame, flag: str | None = None) -> DataFrame:
    """Set ``is_delayed_predicted`` from the prediction of the same flight number, date and origin.

    Flights without a prediction keep what they had. Of several predictions for one flight the newest
    counts. ``flag`` adds a column that tells which rows matched.
    """
    if "is_delayed_predicted" not in flights.columns:
        flights = flights.withColumn("is_delayed_predicted", F.lit(None).cast("boolean"))
    newest = (
        predictions.filter(F.col("flight_number").isNotNull() & F.col("origin_airport").isNotNull())
        .groupBy("flight_number", F.col("flight_date").alias("date"), "origin_airport")
        .agg(
            F.max_by(
                F.struct("is_delayed"), F.struct("prediction_date", F.col("is_delayed").cast("int"))
            ).alias("prediction")
        )
    )
    joined = flights.join(newest, ["flight_number", "date", "origin_airport"], "left")
    matched = F.col("prediction").isNotNull()
    output = [
        F.when(matched, F.col("prediction.is_delayed")).otherwise(F.col(c)).alias(c)
        if c == "is_delayed_predicted"
        else F.col(c)
        for c in flights.columns
    ]
    if flag:
        output.append(matched.alias(flag))
    return joined.select(output)


def apply_minutes(
    predictions: DataFrame,
    scores: DataFrame,
    model_name: str,
    model_version: str,
    order_by: Sequence[Column | str],
    flag: str | None = None,
) -> DataFrame:
    """Write predicted minutes onto predictions of flights expected late, by flight number and origin.

    Of several scores for one flight the last in ``order_by`` order counts.
    """
    position = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    last = scores.groupBy(
        F.col("flight_number").cast("string").alias("score_number"),
        F.col("origin_airport").cast("string").alias("score_origin"),
    ).agg(F.max_by(F.struct("predicted_delay_minutes"), position).alias("score"))
    joined = predictions.join(
        last,
        (F.col("flight_number") == F.col("score_number"))
        & (F.col("origin_airport") == F.col("score_origin"))
        & F.col("is_delayed"),
        "left",
    )
    hit = F.col("score").isNotNull()
    new = {
        "predicted_delay_minutes": F.col("score.predicted_delay_minutes"),
        "regression_model_name": F.lit(model_name),
        "regression_model_version": F.lit(model_version),
    }
    output = [F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in predictions.columns]
    if flag:
        output.append(hit.alias(flag))
    return joined.select(output)
