"""Prediction mix, run KPIs and their text exposition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import elapsed_micros, percentage

_DAYS = 7


def prediction_mix(df: DataFrame, prediction: str = "is_delayed") -> DataFrame:
    """How many predictions, and which share of each class."""
    late = F.col(prediction).cast("int")
    counts = df.agg(
        F.count(F.lit(1)).alias("num_predictions"),
        F.count_if(late == 1).alias("n_late"),
        F.count_if(late == 0).alias("n_not_late"),
    ).filter(F.col("num_predictions") > 0)
    return counts.select(
        "num_predictions",
        percentage(F.col("n_late"), F.col("num_predictions")).alias("pct_delayed"),
        percentage(F.col("n_not_late"), F.col("num_predictions")).alias("pct_not_delayed"),
    )


def run_kpis(runs: DataFrame, since: Column | None = None) -> DataFrame:
    """Deployment KPIs over a week of workflow runs as one row; no runs, no row."""
    if since is not None:
        runs = runs.filter(F.col("created_at").try_cast("timestamp") >= since)
    micros = elapsed_micros(F.col("created_at"), F.col("updated_at"))
    totals = runs.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("conclusion") == "success").alias("success"),
        F.count_if(F.col("conclusion") == "failure").alias("failed"),
        F.count(micros).alias("timed"),
        F.sum(micros).alias("micros"),
    ).filter(F.col("total") > 0)
    return totals.select(
        (F.col("total") / F.lit(float(_DAYS))).alias("deployment_frequency"),
        (F.col("success").cast("double") / F.col("total") * 100).alias("deployment_success_rate"),
        F.when(F.col("timed") > 0, F.col("micros").cast("double") / 1e6 / F.col("timed"))
        .otherwise(F.lit(0.0))
        .alias("deployment_cycle_time_seconds"),
        F.col("total").alias("deployment_total"),
        F.col("failed").alias("deployment_failed"),
    )


def exposition_lines(metrics: DataFrame) -> DataFrame:
    """A one-row metrics frame as exposition text: a type line and a value line per metric."""
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("name"),
                F.concat(F.lit(f"# TYPE {c} gauge\n{c} "), F.col(c).cast("string")).alias("value"),
            )
            for c in metrics.columns
        ]
    )
    return metrics.select(F.inline(lines))
