"""Which day and which route a load covers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CARRIER, EXPECTED_AIRPORTS, HUB_AIRPORT


def reference_day(logical_date: dt.date, mode: str) -> dt.date:
    """``raw`` loads the day before the run, ``scheduled`` the day of the run."""
    if mode not in ("raw", "scheduled"):
        raise ValueError(f"unknown mode {mode!r}")
    return logical_date - dt.timedelta(days=1) if mode == "raw" else logical_date


def in_reference_day(df: DataFrame, column: str, logical_date: dt.date, mode: str) -> DataFrame:
    """Rows of the reference day; a plain range, so it reaches the Parquet scan."""
    day = reference_day(logical_date, mode)
    following = day + dt.timedelta(days=1)
    kind = df.schema[column].dataType.simpleString()
    start, end = (F.lit(f"{d} 00:00:00").cast(kind) for d in (day, following))
    return df.filter((F.col(column) >= start) & (F.col(column) < end))


def on_route(
    df: DataFrame,
    origins: Iterable[str] = EXPECTED_AIRPORTS,
    destination: str = HUB_AIRPORT,
    carrier: str | None = CARRIER,
) -> DataFrame:
    """All origin airports at once; the carrier filter is left out with ``carrier=None``."""
    df = df.filter(F.col("origin_airport").isin(list(origins)) & (F.col("destination_airport") == destination))
    return df.filter(F.col("airline_code") == carrier) if carrier else df
