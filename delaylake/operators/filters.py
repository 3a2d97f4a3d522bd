"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import READINESS_HOURS


def filter_landed(df: DataFrame) -> DataFrame:
    """Flights with an arrival time."""
    return df.filter(F.col("actual_arrival").isNotNull())


def filter_pending(df: DataFrame) -> DataFrame:
    """Flights without an arrival time yet."""
    return df.filter(F.col("actual_arrival").isNull())


def delayed_with_target(df: DataFrame, target: str = "delay_minutes", flag: str = "is_delayed") -> DataFrame:
    """Training rows of the delay regression."""
    return df.filter(F.col(flag) & F.col(target).isNotNull())


def recent(
    df: DataFrame, column: str = "execution_date", hours: int = READINESS_HOURS, as_of: Column | None = None
) -> DataFrame:
    """Rows of the last ``hours`` before ``as_of`` (default: now)."""
    now = F.current_timestamp() if as_of is None else as_of
    return df.filter(F.col(column) >= F.timestamp_add("HOUR", F.lit(-hours), now))
