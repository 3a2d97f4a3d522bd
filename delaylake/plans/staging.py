"""Readiness, and raw to staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import FLIGHT_KEY, NULL_ALARM_DEFAULT, NULL_ALARM_FLIGHTS, NULL_ALARM_WEATHER, WEATHER_KEY
from ..operators.columns import convert_dates, convert_types
from ..operators.dedupe import drop_duplicates
from ..operators.quality import null_profile, readiness
from ..schemas import FLIGHT_TEXTS, FLIGHT_TIMESTAMPS
from ..sinks.lake import Lake
from ..sinks.snapshots import snapshot_replace
from ..sources.tables import incremental_scan

# Columns the readiness check looks at, per table.
_AIRPORT_OF_TABLE = {
    "raw_flights": "origin_airport",
    "scheduled_flights": "origin_airport",
    "raw_weather": "airport_iata",
    "scheduled_weather": "airport_iata",
}


def cycle_ready(lake: Lake, tables: list[tuple[str, str]], as_of: Column | None = None) -> DataFrame:
    """Missing airports per (layer, table) in the freshness window; empty means ready."""
    return readiness(
        {f"{layer}.{table}": (lake.table(layer, table), _AIRPORT_OF_TABLE[table]) for layer, table in tables},
        as_of=as_of,
    )


class NotReady(RuntimeError):
    """An expected airport is missing in the freshness window."""


def require_ready(lake: Lake, tables: list[tuple[str, str]], as_of: Column | None = None) -> None:
    """Refuse to go on with an incomplete cycle; at most one row per table and expected airport reaches the driver."""
    missing = cycle_ready(lake, tables, as_of).collect()
    if missing:
        raise NotReady(", ".join(sorted(f"{r['table_name']}: {r['missing']}" for r in missing)))


def staged_flights(raw: DataFrame) -> DataFrame:
    """Typed flights, one row per business key: the one loaded last."""
    typed = convert_dates(raw, FLIGHT_TIMESTAMPS, ("date",))
    typed = convert_types(typed, texts=FLIGHT_TEXTS, booleans={"wifi_enabled": {"Y": True, "N": False}})
    return drop_duplicates(typed, FLIGHT_KEY, _newest_last(typed, FLIGHT_KEY))


def staged_weather(raw: DataFrame) -> DataFrame:
    """Typed weather, one row per day and airport: the one loaded last."""
    typed = convert_dates(raw, dates=("date",))
    return drop_duplicates(typed, WEATHER_KEY, _newest_last(typed, WEATHER_KEY))


def _newest_last(df: DataFrame, key) -> list[str]:
    """Load time first, then all other columns, so that ties are decided the same way every time."""
    leading = [c for c in ("execution_date",) if c in df.columns]
    return leading + [c for c in df.columns if c not in key and c not in leading]


def stage_flights(lake: Lake, mode: str = "raw", gate: bool = True, as_of: Column | None = None) -> int:
    """Last raw flight snapshot to staging.

    With ``gate`` an incomplete cycle publishes nothing. Null rates above the alarm are logged; they are
    counted by the write itself.
    """
    table = "raw_flights" if mode == "raw" else "scheduled_flights"
    if gate:
        require_ready(lake, [("raw", table)], as_of)
    staged = staged_flights(incremental_scan(lake, "raw", table))
    return snapshot_replace(
        lake, staged, "staging", table, mode, "origin_airport", lake.watermark("raw", table), NULL_ALARM_FLIGHTS
    )


def restage_flights(lake: Lake, mode: str = "raw") -> int:
    """All raw snapshots that changed since the last call, restaged; returns the partitions read.

    The raw table's versions tell which (date, airport) partitions were written since the version that staging was last
    made from, and only those are opened. Within a snapshot and airport one row per business key stays, the one loaded
    last. Partitions that have left the raw table leave staging, in the same commit, which also notes the version.
    """
    table = "raw_flights" if mode == "raw" else "scheduled_flights"
    lake.create("staging", table)
    raw = lake.versioned("raw", table).current()
    staging = lake.versioned("staging", table).current()
    done = int(staging.notes.get(_RESTAGED, 0))
    changed = set(lake.versioned("raw", table).changed_since(done, raw.number))
    gone = {tuple(staging.spec(key)[k] for k in raw.keys) for key in staging.parts} - set(raw.parts)
    if not changed and not gone:
        return 0
    rows = lake.table("raw", table, raw.number, lambda spec: tuple(spec[k] for k in raw.keys) in changed)
    typed = convert_dates(rows, FLIGHT_TIMESTAMPS, ("date",))
    typed = convert_types(typed, texts=FLIGHT_TEXTS, booleans={"wifi_enabled": {"Y": True, "N": False}})
    keys = list(dict.fromkeys([*FLIGHT_KEY, *raw.keys]))
    written = lake.write("staging", table, drop_duplicates(typed, keys, _newest_last(typed, keys))) if changed else {}
    lake.commit(
        "staging",
        table,
        written,
        drop=lambda spec: tuple(spec[k] for k in raw.keys) not in raw.parts,
        watermark=raw.watermark,
        notes={_RESTAGED: str(raw.number)},
        base=staging.number,
    )
    return len(changed)


_RESTAGED = "restaged"


def stage_weather(lake: Lake, mode: str = "raw") -> int:
    """Last raw weather snapshot to staging; null rates above the alarm are logged."""
    table = "raw_weather" if mode == "raw" else "scheduled_weather"
    staged = staged_weather(incremental_scan(lake, "raw", table))
    return snapshot_replace(
        lake, staged, "staging", table, mode, "airport_iata", lake.watermark("raw", table), NULL_ALARM_WEATHER
    )


def snapshot_null_profile(lake: Lake, layer: str, table: str) -> DataFrame:
    """Null rates of the last snapshot of a table against the alarm threshold of its kind."""
    if layer != "staging":
        limit = NULL_ALARM_DEFAULT
    else:
        limit = NULL_ALARM_WEATHER if table.endswith("weather") else NULL_ALARM_FLIGHTS
    profile = null_profile(incremental_scan(lake, layer, table), threshold_percent=limit)
    return profile.withColumn("table_name", F.lit(f"{layer}.{table}"))
