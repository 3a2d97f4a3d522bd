"""Staging to analytics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import FLIGHT_KEY, NULL_ALARM_DEFAULT
from ..operators.columns import drop_columns, extract_array_text
from ..operators.dedupe import latest_version
from ..operators.enrich import add_flight_features, enrich_with_codes, enrich_with_weather
from ..schemas import WEATHER_METRICS
from ..sinks.lake import Lake
from ..sinks.snapshots import snapshot_replace
from ..sinks.upserts import reconcile_table
from ..sources.tables import incremental_scan
from .staging import require_ready


def enriched_flights(
    flights: DataFrame,
    weather: DataFrame,
    weather_codes: DataFrame,
    delay_codes: DataFrame,
    scheduled: bool = False,
) -> DataFrame:
    """One plan: newest version per flight, code to number, three left joins, derived columns.

    The version is selected before the joins: they add no rows, so the result is the same and the
    shuffle carries the narrow rows.
    """
    ties = [c for c in ("execution_date",) if c in flights.columns]
    ties += [c for c in flights.columns if c not in (*FLIGHT_KEY, "date_photo", *ties)]
    newest = latest_version(flights, FLIGHT_KEY, "date_photo", tie_break=ties)
    coded = drop_columns(extract_array_text(newest, ["delay_code"]), ["delay_minutes"])
    joined = enrich_with_codes(enrich_with_weather(coded, weather, "date_photo"), weather_codes, delay_codes)
    return add_flight_features(joined, scheduled)


def _days(df: DataFrame, column: str) -> list[dt.date]:
    """Distinct days; one value per calendar day reaches the driver."""
    return [r[0] for r in df.select(F.col(column).cast("date")).distinct().collect() if r[0] is not None]


def build_analytics(lake: Lake, mode: str = "raw", gate: bool = True, as_of: Column | None = None) -> int:
    """Last staged flight snapshot to analytics, then reconcile it with earlier predictions.

    With ``gate`` an incomplete cycle publishes nothing. Weather is read for the batch's days only. Reconciled are
    the days of the batch and those predicted since the snapshot before, whatever the length of the history.
    """
    scheduled = mode == "scheduled"
    prefix = "scheduled" if scheduled else "raw"
    table = f"{prefix}_flights"
    if gate:
        require_ready(lake, [("staging", table), ("staging", f"{prefix}_weather")], as_of)
    previous = lake.watermark("analytics", table)
    staged = incremental_scan(lake, "staging", table)
    days = _days(staged, "date")
    weather = lake.table("staging", f"{prefix}_weather").select("date", *WEATHER_METRICS, "airport_iata", "date_photo")
    # Weather of a day is photographed on that day or later, never before.
    weather = weather.filter(F.col("date").isin(days))
    if days:
        weather = weather.filter(F.col("date_photo") >= F.lit(min(days).isoformat()).cast("date"))
    batch = enriched_flights(
        staged,
        weather,
        lake.table("ref", "weather_codes"),
        lake.table("ref", "iata_delay_codes"),
        scheduled,
    )
    if not scheduled:
        batch = batch.withColumn("is_delayed_predicted", F.lit(None).cast("boolean"))
    rows = snapshot_replace(
        lake, batch, "analytics", table, mode, "origin_airport", lake.watermark("staging", table), NULL_ALARM_DEFAULT
    )
    if not scheduled and lake.exists("ml", "flight_predictions"):
        predictions = lake.table("ml", "flight_predictions")
        since = predictions
        if previous is not None:
            since = predictions.filter(F.col("prediction_date") >= F.lit(previous.isoformat()).cast("timestamp"))
        reconcile_table(lake, predictions, flight_dates={*days, *_days(since, "flight_date")})
    return rows
