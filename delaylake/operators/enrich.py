"""Weather and code enrichment, and the derived flight columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..constants import WEATHER_KEY
from .columns import apply_columns
from .dedupe import latest_version
from .joins import checked_broadcast, equi_join


def enrich_with_weather(flights: DataFrame, weather: DataFrame, version: str | None = None) -> DataFrame:
    """Left join on (date, airport).

    With ``version`` the newest weather row per day and airport is used, so a day photographed twice
    does not double its flights. Weather has one row per airport and day; the size is checked.
    """
    if version:
        ties = [c for c in weather.columns if c not in (*WEATHER_KEY, version)]
        weather = latest_version(weather, WEATHER_KEY, version, tie_break=ties).drop(version)
    return equi_join(
        flights, checked_broadcast(weather), {"date": "date", "origin_airport": "airport_iata"}, "left"
    ).drop("airport_iata")


def enrich_with_codes(
    df: DataFrame, weather_codes: DataFrame | None = None, delay_codes: DataFrame | None = None
) -> DataFrame:
    """Left joins to the code tables, whose size is checked before they are broadcast."""
    if weather_codes is not None:
        codes = weather_codes.select(
            F.col("code").cast("int").alias("code"), F.col("description").alias("weather_description")
        )
        df = df.withColumn("weather_code", F.col("weather_code").cast("int"))
        df = equi_join(df, checked_broadcast(codes), {"weather_code": "code"}, "left").drop("code")
    if delay_codes is not None:
        codes = delay_codes.select(
            F.col("id").cast("bigint").alias("id"),
            F.col("code").alias("code_iata"),
            F.col("title").alias("title_iata"),
            F.col("description").alias("description_iata"),
        )
        df = df.withColumn("delay_code", F.col("delay_code").cast("bigint"))
        df = equi_join(df, checked_broadcast(codes), {"delay_code": "id"}, "left").drop("id")
    return df


def _calendar_rules() -> dict[str, Column | Callable[[DataFrame], Column]]:
    return {
        "day_of_week": fn.day_of_week(F.col("date")),
        "month": fn.month_number(F.col("date")),
        "dep_hour": lambda df: fn.local_hour(df, "scheduled_departure"),
        "arr_hour": lambda df: fn.local_hour(df, "scheduled_arrival"),
        "day_name": fn.day_name(F.col("date")),
        "month_name": fn.month_name(F.col("date")),
    }


def flight_feature_rules() -> dict[str, Column | Callable[[DataFrame], Column]]:
    """Derived columns of flown flights, in order."""
    return _calendar_rules() | {
        "delay_minutes": fn.delay_minutes(F.col("actual_arrival"), F.col("scheduled_arrival"), F.col("status")),
        "delay_category": fn.delay_category(F.col("delay_minutes")),
        "departure_time_block": fn.time_block(F.col("dep_hour")),
        "is_delayed": fn.is_delayed(F.col("delay_minutes")),
        "is_major_delay": fn.is_major_delay(F.col("delay_minutes")),
        "is_cancelled": fn.is_cancelled(F.col("status")),
        "is_landed": fn.is_landed(F.col("status")),
    }


def scheduled_feature_rules() -> dict[str, Column | Callable[[DataFrame], Column]]:
    """Derived columns of flights still to come: nothing that needs the outcome."""
    return _calendar_rules() | {
        "departure_time_block": fn.time_block(F.col("dep_hour")),
        "is_cancelled": fn.is_cancelled(F.col("status")),
    }


def add_flight_features(df: DataFrame, scheduled: bool = False) -> DataFrame:
    return apply_columns(df, scheduled_feature_rules() if scheduled else flight_feature_rules())
