"""Jobs over the layered tables: ingest, staging, analytics, learning, KPIs."""

from .analytics import build_analytics
from .ingest import import_reference_codes, load_flights, load_weather
from .kpis import publish_run_kpis
from .learning import (
    log_runs,
    predict_delays,
    predict_minutes,
    train_delay_classifier,
    train_minutes_regressor,
)
from .staging import cycle_ready, restage_flights, snapshot_null_profile, stage_flights, stage_weather

__all__ = [
    "build_analytics",
    "cycle_ready",
    "import_reference_codes",
    "load_flights",
    "load_weather",
    "log_runs",
    "predict_delays",
    "predict_minutes",
    "publish_run_kpis",
    "restage_flights",
    "snapshot_null_profile",
    "stage_flights",
    "stage_weather",
    "train_delay_classifier",
    "train_minutes_regressor",
]
