"""Query registry: each entry pairs a Spark query with SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampType

from ...session import configure
from .event_flights import event_flights

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    """Register under the function's name; without ``sql`` the rows cannot be had from plain SQL."""

    def add(query: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return edge(query(configure(spark), sf_dir))

        run.__doc__ = query.__doc__
        QUERIES[query.__name__] = run
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add


def edge(df: DataFrame) -> DataFrame:
    """Types both engines print alike: dates as text, timestamps without zone, 64-bit integers."""

    def plain(field):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            return c.cast("string").alias(field.name)
        if isinstance(field.dataType, TimestampType):
            return c.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, IntegralType):
            return c.cast("bigint").alias(field.name)
        return c

    return df.select([plain(f) for f in df.schema.fields])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_flights(table(spark, sf_dir, "events"))


# The flight view over `events`, as common table expressions; `{}` takes the query.
FLIGHTS_SQL = """
base AS (
  SELECT event_id, user_id, ts, event_type, value,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k,
         date_trunc('hour', ts) + to_minutes(10 - (user_id % 5) * 20) AS arrival
  FROM events
),
flights AS (
  SELECT CAST(event_id AS VARCHAR) AS flight_id,
         CAST(user_id AS VARCHAR) AS flight_number,
         'AF' AS airline_code,
         CAST(ts AS DATE) AS date,
         arrival - INTERVAL 90 MINUTE AS scheduled_departure,
         CASE WHEN event_id % 11 <> 0 THEN ts - INTERVAL 90 MINUTE END AS actual_departure,
         arrival AS scheduled_arrival,
         CASE WHEN event_id % 11 <> 0 THEN ts END AS actual_arrival,
         CASE event_id % 5 WHEN 0 THEN 'NCE' WHEN 1 THEN 'LYS' WHEN 2 THEN 'MRS' WHEN 3 THEN 'TLS' ELSE 'BOD' END
           AS origin_airport,
         'CDG' AS destination_airport,
         CASE event_type WHEN 'error' THEN 'CANCELLED' WHEN 'purchase' THEN 'ARRIVED' WHEN 'view' THEN NULL
           ELSE 'ON_TIME' END AS status,
         CASE WHEN k % 10 = 0 THEN '{{}}'
              WHEN k % 10 = 1 THEN '{{' || k || ',' || (k + 1) || '}}'
              ELSE '{{' || k || '}}' END AS delay_code,
         'F-' || (user_id % 40) AS registration,
         CASE k % 3 WHEN 0 THEN '320' WHEN 1 THEN '321' ELSE '223' END AS type_code,
         CASE k % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS wifi_enabled,
         CAST(CAST(ts AS DATE) + CAST(event_id % 3 AS INTEGER) AS DATE) AS date_photo,
         ts AS execution_date,
         k, value, event_id
  FROM base
),
features AS (
  SELECT *,
         isodow(date) AS day_of_week,
         month(date) AS month,
         hour(scheduled_departure AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris') AS dep_hour,
         hour(scheduled_arrival AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris') AS arr_hour,
         CASE WHEN status IS DISTINCT FROM 'CANCELLED'
              THEN (epoch_us(actual_arrival) - epoch_us(scheduled_arrival)) / 1000000.0::DOUBLE / 60.0::DOUBLE END
           AS delay_minutes
  FROM flights
),
flagged AS (
  SELECT *,
         CASE WHEN delay_minutes <= 0 THEN 'on_time' WHEN delay_minutes <= 15 THEN 'minor_delay'
              WHEN delay_minutes IS NOT NULL THEN 'major_delay' END AS delay_category,
         CASE WHEN dep_hour < 6 THEN 'night' WHEN dep_hour < 12 THEN 'morning' WHEN dep_hour < 18 THEN 'afternoon'
              ELSE 'evening' END AS departure_time_block,
         coalesce(delay_minutes > 15, false) AS is_delayed,
         coalesce(delay_minutes > 60, false) AS is_major_delay,
         coalesce(status = 'CANCELLED', false) AS is_cancelled,
         coalesce(status = 'ARRIVED', false) AS is_landed
  FROM features
),
weather AS (
  SELECT date, origin_airport AS airport_iata,
         max(value) AS temp_max, min(value) AS temp_min,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / count(*) / 100.0::DOUBLE AS temp_mean,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 100.0::DOUBLE AS precipitation_sum,
         CAST(count(*) FILTER (k % 2 = 0) AS DOUBLE) AS rain_sum,
         CAST(count(*) FILTER (k % 7 = 0) AS DOUBLE) AS snowfall_sum,
         CAST(count(*) % 24 AS DOUBLE) AS precipitation_hours,
         CAST(max(k) AS DOUBLE) AS wind_speed_max,
         CAST(max(k) AS DOUBLE) * 1.5 AS wind_gusts_max,
         max(k) * 7 % 360 AS wind_direction,
         max(k) AS weather_code
  FROM flights GROUP BY date, origin_airport
),
predictions AS (
  SELECT flight_number, date AS flight_date, min(origin_airport) AS origin_airport,
         min(destination_airport) AS destination_airport, min(hour(scheduled_departure)) AS dep_hour,
         max(k) % 2 = 0 AS is_delayed, max(execution_date) AS prediction_date
  FROM flights GROUP BY flight_number, date
)
""".replace("{{", "{").replace("}}", "}")


def over_flights(query: str, *extra: str) -> str:
    """SQL over the views above; ``extra`` adds further common table expressions."""
    return "WITH " + ",\n".join([FLIGHTS_SQL.strip(), *extra]) + "\n" + query
