"""Nested documents and scans, over documents packed from the event table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ...session import shared_folder
from ...sinks.lake import Lake
from ...sinks.files import write_text
from ...sources.documents import (
    flatten_flights,
    flatten_structs,
    flatten_weather,
    parse_weather_documents,
    read_flight_documents,
)
from ...sources.tables import table_scan
from ..ingest import load_flights, load_weather
from .base import flights, over_flights, register, table
from .event_flights import event_flight_documents, event_weather, event_weather_documents


@register("""
SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS "payload.props.k",
       event_type AS "payload.kind"
FROM events
""")
def json_props(spark, sf_dir):
    """Nested payload to dotted columns."""
    payload = F.struct(F.from_json("props", "k int").alias("props"), F.col("event_type").alias("kind"))
    return flatten_structs(table(spark, sf_dir, "events").select("event_id", payload.alias("payload")))


@register(over_flights("""
SELECT CAST(date AS VARCHAR) AS date, temp_max, temp_min, temp_mean, precipitation_sum, rain_sum, snowfall_sum,
       precipitation_hours, wind_speed_max, wind_gusts_max, CAST(wind_direction AS BIGINT) AS wind_direction,
       CAST(weather_code AS BIGINT) AS weather_code, airport_iata
FROM weather
"""))
def weather_arrays(spark, sf_dir):
    """Weather documents of parallel arrays to one row per day."""
    documents = event_weather_documents(event_weather(flights(spark, sf_dir)))
    return flatten_weather(parse_weather_documents(documents, "document"))


@register(over_flights("""
SELECT flight_id, flight_number, airline_code, CAST(date AS VARCHAR) AS date,
       strftime(scheduled_departure, '%Y-%m-%dT%H:%M:%S.%fZ') AS scheduled_departure,
       CASE WHEN event_id % 13 = 0 THEN 'not_a_date' ELSE strftime(actual_departure, '%Y-%m-%dT%H:%M:%S.%fZ') END
         AS actual_departure,
       strftime(scheduled_arrival, '%Y-%m-%dT%H:%M:%S.%fZ') AS scheduled_arrival,
       strftime(actual_arrival, '%Y-%m-%dT%H:%M:%S.%fZ') AS actual_arrival,
       origin_airport, destination_airport, status, CAST(NULL AS VARCHAR) AS delay_minutes, delay_code, registration,
       type_code, 'AIRBUS A' || type_code AS type_name, 'AF' AS owner_airline, wifi_enabled
FROM flights
"""))
def flight_json_flatten(spark, sf_dir):
    """Landed flight documents to flat rows: last leg, NULL entries dropped, codes normalised."""
    path = shared_folder(spark, "flight_documents")
    write_text(event_flight_documents(flights(spark, sf_dir)), path)
    return flatten_flights(read_flight_documents(spark, path, multi_line=False))


@register("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
def scan_table(spark, sf_dir):
    """Column list and condition over a named table."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("delaylake_orders")
    return table_scan(
        spark, "delaylake_orders", " o_orderkey , o_totalprice", "o_orderstatus = 'F' AND o_totalprice > 1000"
    )


@register("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def scan_query(spark, sf_dir):
    """A full query in place of columns and condition."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("delaylake_orders")
    return table_scan(
        spark,
        "delaylake_orders",
        query="SELECT o_orderstatus, count(*) AS n FROM delaylake_orders GROUP BY o_orderstatus",
    )


_RUN = dt.datetime(2024, 1, 11, 7, tzinfo=dt.timezone.utc)


def _loaded(spark, sf_dir):
    """A lake after one raw load of all landed flight documents."""
    path = shared_folder(spark, "landed_flights")
    write_text(event_flight_documents(flights(spark, sf_dir)), path)
    lake = Lake.scratch(spark, "raw_load")
    load_flights(lake, read_flight_documents(spark, path, multi_line=False), "raw", _RUN, "flights", "run-1")
    return lake


@register(over_flights("""
SELECT flight_id, origin_airport, status, delay_code, '2024-01-11' AS date_photo, 'run-1' AS instance_id
FROM flights WHERE date = DATE '2024-01-10'
"""))
def load_flights_job(spark, sf_dir):
    """The raw load of one day: its flights."""
    return _loaded(spark, sf_dir).table("raw", "raw_flights").select(
        "flight_id", "origin_airport", "status", "delay_code", "date_photo", "instance_id"
    )


@register(over_flights("""
SELECT 'another day' AS reason, flight_id, '2024-01-11' AS date_photo FROM flights WHERE date <> DATE '2024-01-10'
"""))
def quarantined_flights(spark, sf_dir):
    """And what that load kept aside."""
    kept = _loaded(spark, sf_dir).table("ops", "quarantine")
    return kept.select("reason", F.get_json_object("content", "$.flight_id").alias("flight_id"), "date_photo")


@register(over_flights("""
SELECT CAST(date AS VARCHAR) AS date, airport_iata, temp_max, precipitation_hours, '2024-01-11' AS date_photo
FROM weather WHERE date = DATE '2024-01-10'
"""))
def load_weather_job(spark, sf_dir):
    """The raw weather load of one day."""
    documents = event_weather_documents(event_weather(flights(spark, sf_dir)))
    lake = Lake.scratch(spark, "raw_weather")
    load_weather(lake, parse_weather_documents(documents, "document"), "raw", _RUN, "weather", "run-1")
    return lake.table("raw", "raw_weather").select("date", "airport_iata", "temp_max", "precipitation_hours", "date_photo")
