"""Serving lookups as DataFrame queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    AIRPORT_CITIES,
    HUB_AIRPORT,
    MESSAGE_BAD_HOUR,
    MESSAGE_NO_PREDICTION,
    MESSAGE_SAME_AIRPORT,
    MESSAGE_UNKNOWN_AIRPORT,
    MESSAGE_UNKNOWN_DESTINATION,
    MESSAGE_UNKNOWN_ORIGIN,
)
from .joins import lookup_with_default

_KEYS = ("flight_date", "dep_hour", "origin_airport", "destination_airport")


def _known(code: str) -> str:
    if code.upper() not in AIRPORT_CITIES:
        raise ValueError(f"{MESSAGE_UNKNOWN_AIRPORT}{code}")
    return code.upper()


def origins(df: DataFrame, column: str = "origin_airport") -> DataFrame:
    """Origin airports in use with their city, hub left out."""
    codes = df.filter(F.col(column) != HUB_AIRPORT).select(F.col(column).alias("code")).distinct()
    return lookup_with_default(codes, "code", AIRPORT_CITIES, "city").orderBy("code")


def destinations(predictions: DataFrame, origin: str) -> DataFrame:
    """Destinations predicted for an origin, with their city, sorted."""
    codes = (
        predictions.filter(F.col("origin_airport") == _known(origin))
        .select(F.col("destination_airport").alias("code"))
        .distinct()
    )
    return lookup_with_default(codes, "code", AIRPORT_CITIES, "city").orderBy("code")


def departure_hours(predictions: DataFrame, origin: str, destination: str, flight_date: dt.date) -> DataFrame:
    """Departure hours predicted for a route and day, sorted."""
    return (
        predictions.filter(
            (F.col("origin_airport") == _known(origin))
            & (F.col("destination_airport") == _known(destination))
            & (F.col("flight_date") == F.lit(flight_date.isoformat()).cast("date"))
        )
        .select("dep_hour")
        .distinct()
        .orderBy("dep_hour")
    )


def request_error() -> Column:
    """The first rule a request breaks, NULL for a valid one."""
    airports = list(AIRPORT_CITIES)
    origin, destination = F.upper("origin_airport"), F.upper("destination_airport")
    return (
        F.when(~F.coalesce(origin.isin(airports), F.lit(False)), F.concat(F.lit(MESSAGE_UNKNOWN_ORIGIN), F.coalesce("origin_airport", F.lit(""))))
        .when(
            ~F.coalesce(destination.isin(airports), F.lit(False)),
            F.concat(F.lit(MESSAGE_UNKNOWN_DESTINATION), F.coalesce("destination_airport", F.lit(""))),
        )
        .when((F.col("dep_hour") < 0) | (F.col("dep_hour") > 23), F.lit(MESSAGE_BAD_HOUR))
        .when(origin == destination, F.lit(MESSAGE_SAME_AIRPORT))
    )


def validate_requests(requests: DataFrame) -> DataFrame:
    """Requests with an ``error`` column."""
    return requests.withColumn("error", request_error())


def prediction_lookup(requests: DataFrame, predictions: DataFrame) -> DataFrame:
    """Prediction for every valid request (date, hour, origin, destination), or a message.

    Several flights may share a request's key; the smallest flight number answers. They are reduced to
    one row per key before the shuffle. Invalid requests come back with their error as message.
    """
    checked = validate_requests(requests).withColumns(
        {"origin_airport": F.upper("origin_airport"), "destination_airport": F.upper("destination_airport")}
    )
    answers = predictions.groupBy(*_KEYS).agg(F.min_by(F.struct("is_delayed"), "flight_number").alias("answer"))
    joined = checked.join(answers, list(_KEYS), "left")
    found = F.col("error").isNull() & F.col("answer").isNotNull()
    return joined.select(
        *[F.col(c) for c in requests.columns],
        F.when(found, F.col("answer.is_delayed")).alias("is_delayed"),
        F.when(~found, F.coalesce("error", F.lit(MESSAGE_NO_PREDICTION))).alias("message"),
    )
