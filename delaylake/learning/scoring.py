"""Batch scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clip_and_round
from ..operators.joins import semi_join
from .scorers import predicted


def score(df: DataFrame, model: PipelineModel, output: str = "is_delayed") -> DataFrame:
    """The rows with the predicted class as boolean."""
    return predicted(df, model, output)


def prediction_rows(
    scored: DataFrame,
    run_id: str,
    model_name: str,
    model_version: str,
    prediction_date: Column | None = None,
    order_columns: Sequence[str] = (),
) -> DataFrame:
    """Scored flights as rows of the predictions table, next to the columns that order them."""
    when = F.current_timestamp() if prediction_date is None else prediction_date
    return scored.select(
        "flight_number",
        F.col("date").alias("flight_date"),
        "dep_hour",
        "origin_airport",
        "destination_airport",
        "departure_time_block",
        "day_of_week",
        "month",
        "is_cancelled",
        "is_delayed",
        when.alias("prediction_date"),
        F.lit(run_id).alias("run_id"),
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        *order_columns,
    )


def minutes_scores(flights: DataFrame, predictions: DataFrame, model: PipelineModel, flight_date) -> DataFrame:
    """Predicted minutes for flights expected late on ``flight_date``, never negative, one decimal."""
    late = predictions.filter(F.col("is_delayed") & (F.col("flight_date") == F.lit(flight_date)))
    candidates = semi_join(
        flights,
        late,
        {"flight_number": "flight_number", "origin_airport": "origin_airport"},
        as_text=True,
    )
    scored = predicted(candidates.select(*flights.columns), model, "predicted_minutes")
    return scored.select(*flights.columns, clip_and_round(F.col("predicted_minutes")).alias("predicted_delay_minutes"))
