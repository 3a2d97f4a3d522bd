"""Delay measures and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import MAJOR_DELAY_MIN_MINUTES, MINOR_DELAY_MAX_MINUTES, ON_TIME_MAX_MINUTES


def is_cancelled(status: Column) -> Column:
    return status.eqNullSafe(F.lit("CANCELLED"))


def is_landed(status: Column) -> Column:
    return status.eqNullSafe(F.lit("ARRIVED"))


def delay_minutes(actual: Column, scheduled: Column, status: Column) -> Column:
    """Minutes late at arrival, negative when early; NULL for cancelled flights or a missing time."""
    micros = F.unix_micros(actual.cast("timestamp")) - F.unix_micros(scheduled.cast("timestamp"))
    return F.when(~is_cancelled(status), micros / F.lit(1e6) / F.lit(60.0))


def delay_category(minutes: Column) -> Column:
    return (
        F.when(minutes <= ON_TIME_MAX_MINUTES, "on_time")
        .when(minutes <= MINOR_DELAY_MAX_MINUTES, "minor_delay")
        .when(minutes.isNotNull(), "major_delay")
    )


def is_delayed(minutes: Column) -> Column:
    return F.coalesce(minutes > MINOR_DELAY_MAX_MINUTES, F.lit(False))


def is_major_delay(minutes: Column) -> Column:
    return F.coalesce(minutes > MAJOR_DELAY_MIN_MINUTES, F.lit(False))


def time_block(hour: Column) -> Column:
    return (
        F.when(hour < 6, "night")
        .when(hour < 12, "morning")
        .when(hour < 18, "afternoon")
        .when(hour.isNotNull(), "evening")
    )
