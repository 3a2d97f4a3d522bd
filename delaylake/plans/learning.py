"""Train, promote and score over the layered tables."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CLASSIFIER_CATEGORICAL,
    CLASSIFIER_NUMERIC,
    CLASSIFIER_REGISTRY,
    F1_STAGING_MIN,
    FLIGHT_KEY,
    MAE_STAGING_MAX,
    REGRESSOR_FEATURES,
    REGRESSOR_REGISTRY,
)
from ..learning.registry import production_version, promote, register, tag_version
from ..learning.scoring import minutes_scores, prediction_rows, score
from ..learning.training import Fitted, run_rows, train_classifiers, train_regressors
from ..operators.kpis import prediction_mix
from ..session import written
from ..sinks.lake import Lake
from ..sinks.upserts import update_minutes_table, upsert_predictions_table
from .staging import require_ready

logger = logging.getLogger(__name__)

_LOAD_ORDER = ("execution_date", "flight_id")


def log_runs(lake: Lake, runs: DataFrame) -> None:
    """Rows of the run log (M13); a run that logs again replaces its own rows, so a retry adds none."""
    lake.create("ml", "runs")
    lake.replace_partitions("ml", "runs", runs)


def _publish(
    lake: Lake, fitted: Sequence[Fitted], best: Fitted, registry_name: str, metric: str, threshold: float, direction: str
) -> str | None:
    """Save the best model, log all runs, promote; returns the stage reached."""
    now = dt.datetime.now(dt.timezone.utc)
    log_runs(lake, run_rows(lake.spark, fitted, registry_name, now))

    lake.create("ml", "model_registry")
    base = lake.version("ml", "model_registry")
    path = f"{lake.root}/models/{registry_name}/{best.run_id}"
    tags = {
        "model_type": best.name,
        metric: str(round(best.metrics[metric], 4)),
        "trained_at": now.strftime("%Y-%m-%d %H:%M"),
        **best.params,
    }
    registry = lake.table("ml", "model_registry", base, lambda spec: spec["name"] == registry_name)
    registry, version = register(registry, registry_name, best.metrics[metric], path, tags)
    # Classifier versions that never reached production are archived; regressor versions stay.
    decided = promote(registry, {registry_name: version}, threshold, direction, archive_superseded=direction == "max")
    stage = {r["version"]: r["stage"] for r in decided.select("version", "stage").collect()}.get(version)
    if stage is None:
        logger.warning("%s: %s does not pass %s, not registered", registry_name, best.metrics[metric], threshold)
        return None
    best.model.write().overwrite().save(path)
    lake.replace_partitions("ml", "model_registry", decided, base)
    return stage


def train_delay_classifier(lake: Lake, estimators: Mapping[str, Estimator] | None = None) -> str | None:
    """Train on the analytics table, keep the best F1."""
    fitted = train_classifiers(
        lake.table("analytics", "raw_flights"),
        FLIGHT_KEY,
        CLASSIFIER_CATEGORICAL,
        CLASSIFIER_NUMERIC,
        estimators=estimators,
    )
    best = max(fitted, key=lambda f: f.metrics["f1"])
    return _publish(lake, fitted, best, CLASSIFIER_REGISTRY, "f1", F1_STAGING_MIN, "max")


def train_minutes_regressor(lake: Lake, estimators: Mapping[str, Estimator] | None = None) -> str | None:
    """Train on delayed flights, keep the smallest MAE."""
    fitted = train_regressors(
        lake.table("analytics", "raw_flights"), FLIGHT_KEY, REGRESSOR_FEATURES, estimators=estimators
    )
    best = min(fitted, key=lambda f: f.metrics["mae"])
    return _publish(lake, fitted, best, REGRESSOR_REGISTRY, "mae", MAE_STAGING_MAX, "min")


def predict_delays(
    lake: Lake, run_id: str, prediction_date: Column | None = None, gate: bool = True, as_of: Column | None = None
) -> DataFrame:
    """Score the scheduled flights, upsert the predictions, return their mix.

    With ``gate`` every airport has to have arrived before ``as_of`` (default: now).
    """
    if gate:
        require_ready(lake, [("analytics", "scheduled_flights")], as_of)
    champion = production_version(lake.table("ml", "model_registry"), CLASSIFIER_REGISTRY)
    if champion is None:
        raise LookupError(f"no production version of {CLASSIFIER_REGISTRY}")
    flights = lake.table("analytics", "scheduled_flights")
    scored = score(flights, PipelineModel.load(champion["model_path"]))
    rows = prediction_rows(
        scored, run_id, champion["tags"]["model_type"], str(champion["version"]), prediction_date, _LOAD_ORDER
    )
    rows = written(rows, "predictions")  # scored once for the table and the mix
    upsert_predictions_table(lake, rows, _LOAD_ORDER)
    mix = prediction_mix(rows)
    mix = lake.spark.createDataFrame(mix.collect(), mix.schema)
    _log_scoring(lake, run_id, champion, mix)
    return mix


def _log_scoring(lake: Lake, run_id: str, champion: dict, mix: DataFrame) -> None:
    """Log a scoring run, and note it on the model version that served it."""
    counts = mix.first()
    if counts is None:
        return
    metrics = F.create_map(*[part for c in mix.columns for part in (F.lit(c), F.col(c).cast("double"))])
    model = champion["tags"]["model_type"]
    params = F.create_map(F.lit("model_used"), F.lit(model), F.lit("model_path"), F.lit(champion["model_path"]))
    run = mix.select(
        F.lit(run_id).alias("run_id"),
        F.lit(f"{model}_prediction").alias("model"),
        params.alias("params"),
        metrics.alias("metrics"),
        F.current_timestamp().alias("logged_at"),
        F.lit(champion["name"]).alias("experiment"),
    )
    log_runs(lake, run)
    tags = {
        "last_prediction_run_id": run_id,
        "last_num_predictions": str(counts["num_predictions"]),
        "last_pct_delayed": str(counts["pct_delayed"]),
    }
    base = lake.version("ml", "model_registry")
    registry = lake.table("ml", "model_registry", base, lambda spec: spec["name"] == champion["name"])
    lake.replace_partitions("ml", "model_registry", tag_version(registry, champion["version"], tags), base)


def predict_minutes(lake: Lake, flight_date: dt.date) -> int:
    """Minutes for the flights predicted late that day; 0 when there is no model or no such flight."""
    if not (lake.exists("ml", "model_registry") and lake.exists("ml", "flight_predictions")):
        return 0
    champion = production_version(lake.table("ml", "model_registry"), REGRESSOR_REGISTRY)
    if champion is None:
        logger.warning("no production version of %s", REGRESSOR_REGISTRY)
        return 0
    scores = minutes_scores(
        lake.table("analytics", "scheduled_flights"),
        lake.table("ml", "flight_predictions"),
        PipelineModel.load(champion["model_path"]),
        flight_date,
    )
    return update_minutes_table(
        lake,
        scores,
        flight_date,
        champion["tags"]["model_type"],
        str(champion["version"]),
        _LOAD_ORDER,
    )
