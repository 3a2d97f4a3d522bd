"""Derived columns and enrichment over the flight view."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ...operators import (
    BatchFunction,
    add_flight_features,
    add_snapshot_columns,
    apply_columns,
    apply_frame_function,
    enrich_with_codes,
    enrich_with_weather,
    latest_version,
)
from ...session import written
from ..analytics import enriched_flights
from ..staging import staged_flights, staged_weather
from .base import flights, over_flights, register, table
from .event_flights import event_raw_flights, event_weather

_ROUTE_DAY = ("flight_number", "date", "origin_airport", "destination_airport")
_FEATURES = (
    "flight_id", "day_of_week", "month", "dep_hour", "arr_hour", "day_name", "month_name", "delay_minutes",
    "delay_category", "departure_time_block", "is_delayed", "is_major_delay", "is_cancelled", "is_landed",
)


@register(over_flights("""
SELECT origin_airport, departure_time_block, count(*) AS n_flights,
       count(*) FILTER (is_delayed) AS n_delayed,
       count(n_name) AS n_described,
       round(avg(delay_minutes), 4) AS avg_delay
FROM (
  SELECT * FROM flagged
  QUALIFY row_number() OVER (PARTITION BY flight_number, date, origin_airport, destination_airport
                             ORDER BY date_photo DESC NULLS FIRST, execution_date DESC, flight_id DESC) = 1
) f LEFT JOIN nation ON f.k = n_nationkey
GROUP BY ALL
"""))
def delay_by_origin_block(spark, sf_dir):
    """Latest version per route and day, coded, then delay by origin and part of the day."""
    newest = latest_version(
        flights(spark, sf_dir), _ROUTE_DAY, "date_photo", tie_break=["execution_date", "flight_id"]
    )
    codes = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("code"), F.col("n_name").alias("description")
    )
    coded = enrich_with_codes(newest.withColumn("weather_code", F.col("k")), weather_codes=codes)
    return (
        add_flight_features(coded)
        .groupBy("origin_airport", "departure_time_block")
        .agg(
            F.count(F.lit(1)).alias("n_flights"),
            F.count_if("is_delayed").alias("n_delayed"),
            F.count("weather_description").alias("n_described"),
            F.round(F.avg("delay_minutes"), 4).alias("avg_delay"),
        )
    )


@register(over_flights("""
SELECT flight_id, CAST(day_of_week AS BIGINT) AS day_of_week, CAST(month AS BIGINT) AS month,
       CAST(dep_hour AS BIGINT) AS dep_hour, CAST(arr_hour AS BIGINT) AS arr_hour,
       dayname(date) AS day_name, monthname(date) AS month_name, delay_minutes, delay_category,
       departure_time_block, is_delayed, is_major_delay, is_cancelled, is_landed
FROM flagged
"""))
def delay_features(spark, sf_dir):
    """All derived columns of flown flights."""
    return add_flight_features(flights(spark, sf_dir)).select(*_FEATURES)


@register(over_flights("""
SELECT flight_id, CAST(day_of_week AS BIGINT) AS day_of_week, CAST(dep_hour AS BIGINT) AS dep_hour,
       departure_time_block, is_cancelled
FROM flagged
"""))
def scheduled_features(spark, sf_dir):
    """Derived columns of flights still to come."""
    return add_flight_features(flights(spark, sf_dir), scheduled=True).select(
        "flight_id", "day_of_week", "dep_hour", "departure_time_block", "is_cancelled"
    )


@register("""
SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS execution_date,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_photo,
       CAST(week(o_orderdate) AS BIGINT) AS semaine_photo,
       CAST(year(o_orderdate) AS BIGINT) AS annee_photo,
       CAST(isoyear(o_orderdate) AS BIGINT) AS iso_year,
       'orders_load' AS dag_id, 'run-1' AS instance_id
FROM orders
""")
def snapshot_columns(spark, sf_dir):
    """Load columns, with the order date as load time."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return add_snapshot_columns(
        orders, "orders_load", "run-1", logical_date=F.col("o_orderdate"), iso_year_column="iso_year"
    ).drop("o_orderdate")


@register(over_flights("""
SELECT f.flight_id, f.origin_airport, w.temp_max, w.temp_min, w.temp_mean, w.weather_code
FROM flights f LEFT JOIN weather w ON f.date = w.date AND f.origin_airport = w.airport_iata
"""))
def enrich_weather(spark, sf_dir):
    """Flights with the weather of their day and origin."""
    rows = flights(spark, sf_dir)
    weather = written(event_weather(rows), "weather")
    return enrich_with_weather(rows.select("flight_id", "date", "origin_airport"), weather).select(
        "flight_id", "origin_airport", "temp_max", "temp_min", "temp_mean", "weather_code"
    )


@register(over_flights("""
SELECT f.flight_id, f.k AS weather_code, n.n_name AS weather_description, f.event_id % 40 AS delay_code,
       p.p_brand AS code_iata, p.p_type AS title_iata, p.p_name AS description_iata
FROM flights f LEFT JOIN nation n ON f.k = n.n_nationkey LEFT JOIN part p ON f.event_id % 40 = p.p_partkey
"""))
def enrich_codes(spark, sf_dir):
    """Flights with both code tables; unknown codes stay."""
    weather_codes = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS code", "n_name AS description")
    delay_codes = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "p_brand AS code", "p_type AS title", "p_name AS description"
    )
    rows = flights(spark, sf_dir).select(
        "flight_id", F.col("k").alias("weather_code"), (F.col("event_id") % 40).alias("delay_code")
    )
    return enrich_with_codes(rows, weather_codes, delay_codes)


@register(over_flights("""
SELECT flight_id, flight_number, CAST(date AS VARCHAR) AS date, scheduled_departure,
       CASE WHEN event_id % 13 <> 0 THEN actual_departure END AS actual_departure,
       scheduled_arrival, actual_arrival, status, delay_code, k % 3 = 0 AS wifi_enabled
FROM (SELECT * REPLACE (CASE WHEN k % 3 = 2 THEN NULL ELSE k END AS k) FROM flights)
"""))
def staging_flights(spark, sf_dir):
    """Raw text flights, typed and deduplicated."""
    raw = event_raw_flights(flights(spark, sf_dir)).drop("k", "value", "event_id")
    return staged_flights(raw).select(
        "flight_id", "flight_number", "date", "scheduled_departure", "actual_departure", "scheduled_arrival",
        "actual_arrival", "status", "delay_code", "wifi_enabled",
    )


@register(over_flights("""
SELECT CAST(date AS VARCHAR) AS date, airport_iata, temp_max, temp_mean, CAST(weather_code AS BIGINT) AS weather_code
FROM weather
"""))
def staging_weather(spark, sf_dir):
    """Weather loaded twice, as text dates: one row per day and airport remains, the later load."""
    weather = event_weather(flights(spark, sf_dir)).withColumn("date", F.col("date").cast("string"))
    loads = weather.withColumn("execution_date", F.lit("2024-02-01 06:00:00").cast("timestamp")).unionByName(
        weather.withColumns(
            {"execution_date": F.lit("2024-02-01 05:00:00").cast("timestamp"), "temp_max": F.lit(-1.0)}
        )
    )
    return staged_weather(loads).select("date", "airport_iata", "temp_max", "temp_mean", "weather_code")


@register(over_flights("""
SELECT f.flight_id, f.origin_airport, try_cast(trim(f.delay_code, '{}') AS BIGINT) AS delay_code,
       f.delay_minutes, f.delay_category, f.departure_time_block, f.is_delayed,
       w.temp_max, CAST(w.weather_code AS BIGINT) AS weather_code, n.n_name AS weather_description,
       p.p_brand AS code_iata, p.p_name AS description_iata
FROM flagged f
LEFT JOIN weather w ON f.date = w.date AND f.origin_airport = w.airport_iata
LEFT JOIN nation n ON w.weather_code = n.n_nationkey
LEFT JOIN part p ON try_cast(trim(f.delay_code, '{}') AS BIGINT) = p.p_partkey
"""))
def analytics_flights(spark, sf_dir):
    """The whole analytics plan: version, code parsing, three joins, derived columns."""
    rows = flights(spark, sf_dir)
    weather = written(event_weather(rows), "weather").withColumn("date_photo", F.col("date"))
    twice = weather.unionByName(
        weather.withColumns({"date_photo": F.date_sub("date", 1), "temp_max": F.lit(-1.0)})
    )
    weather_codes = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS code", "n_name AS description")
    delay_codes = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "p_brand AS code", "p_type AS title", "p_name AS description"
    )
    return enriched_flights(rows.drop("k", "value", "event_id"), twice, weather_codes, delay_codes).select(
        "flight_id", "origin_airport", "delay_code", "delay_minutes", "delay_category", "departure_time_block",
        "is_delayed", "temp_max", "weather_code", "weather_description", "code_iata", "description_iata",
    )


@register(over_flights("""
SELECT flight_id, CASE WHEN k >= 50 THEN 'high-' || (k - 50) ELSE 'low-' || k END AS band, k + 7 AS shifted
FROM flights
"""))
def row_function(spark, sf_dir):
    """A Python function of whole columns next to a built-in column; the second rule sees the first."""

    def band(rows, pivot, step=0):
        high = "high-" + (rows["k"] - pivot).astype(str)
        return high.where(rows["k"] >= pivot, "low-" + (rows["k"] + step).astype(str))

    rows = flights(spark, sf_dir).select("flight_id", "k")
    return apply_columns(
        rows,
        {
            "band": BatchFunction(band, "string", args=(50,), kwargs={"step": 0}),
            "shifted": lambda df: F.col("k") + 7,
            "ignored": "not a rule",
        },
    ).select("flight_id", "band", "shifted")


@register(over_flights("SELECT flight_id, value * 2 AS doubled FROM flights WHERE value > 10"))
def frame_function(spark, sf_dir):
    """A table-to-table function on pandas batches."""

    def keep_and_double(frame: pd.DataFrame) -> pd.DataFrame:
        kept = frame[frame["value"] > 10]
        return pd.DataFrame({"flight_id": kept["flight_id"], "doubled": kept["value"] * 2})

    rows = flights(spark, sf_dir).select("flight_id", "value")
    return apply_frame_function(rows, keep_and_double, "flight_id string, doubled double")
