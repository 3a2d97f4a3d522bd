"""Lookups and KPIs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ...operators import (
    departure_hours,
    destinations,
    exposition_lines,
    origins,
    prediction_lookup,
    run_kpis,
    validate_requests,
)
from .base import flights, over_flights, register, table
from .event_flights import event_predictions
from .cleaning import _newest_event

_CITY_SQL = """cities AS (
  SELECT * FROM (VALUES ('NCE', 'Nice'), ('TLS', 'Toulouse'), ('LYS', 'Lyon'), ('MRS', 'Marseille'),
    ('BOD', 'Bordeaux'), ('CDG', 'Paris Charles de Gaulle')) c(code, city)
)"""


@register(over_flights("""
SELECT DISTINCT origin_airport AS code, city FROM flights JOIN cities ON origin_airport = code
""", _CITY_SQL))
def origin_airports(spark, sf_dir):
    return origins(flights(spark, sf_dir))


@register(over_flights("""
SELECT DISTINCT destination_airport AS code, city FROM predictions JOIN cities ON destination_airport = code
WHERE origin_airport = 'NCE'
""", _CITY_SQL))
def destination_airports(spark, sf_dir):
    return destinations(event_predictions(flights(spark, sf_dir)), "nce")


@register(over_flights("""
SELECT DISTINCT CAST(dep_hour AS BIGINT) AS dep_hour FROM predictions
WHERE origin_airport = 'BOD' AND destination_airport = 'CDG' AND flight_date = DATE '2024-01-10'
"""))
def hours_of_day(spark, sf_dir):
    return departure_hours(event_predictions(flights(spark, sf_dir)), "bod", "cdg", dt.date(2024, 1, 10))


_REQUESTS_SQL = """requests AS (
  SELECT flight_id AS request_id, date AS flight_date, hour(scheduled_departure) + k % 3 AS dep_hour,
         CASE event_id % 8 WHEN 5 THEN 'XXX' WHEN 6 THEN 'cdg' ELSE lower(origin_airport) END AS origin_airport,
         CASE event_id % 9 WHEN 5 THEN 'YYY' ELSE 'CDG' END AS destination_airport
  FROM flights
),
checked AS (
  SELECT *,
    CASE WHEN upper(origin_airport) NOT IN (SELECT code FROM cities)
           THEN 'Aéroport d''origine inconnu : ' || origin_airport
         WHEN upper(destination_airport) NOT IN (SELECT code FROM cities)
           THEN 'Aéroport de destination inconnu : ' || destination_airport
         WHEN dep_hour < 0 OR dep_hour > 23 THEN 'L''heure doit être entre 0 et 23.'
         WHEN upper(origin_airport) = upper(destination_airport) THEN 'Origine et destination identiques.' END AS error
  FROM requests
)"""


def _requests(rows):
    """One request per flight: lower case, unknown airports, hours past midnight."""
    kind = F.col("event_id")
    return rows.select(
        F.col("flight_id").alias("request_id"),
        F.col("date").alias("flight_date"),
        (F.hour("scheduled_departure") + F.col("k") % 3).alias("dep_hour"),
        F.when(kind % 8 == 5, "XXX").when(kind % 8 == 6, "cdg").otherwise(F.lower("origin_airport")).alias(
            "origin_airport"
        ),
        F.when(kind % 9 == 5, "YYY").otherwise("CDG").alias("destination_airport"),
    )


@register(over_flights("SELECT request_id, error FROM checked", _CITY_SQL, _REQUESTS_SQL))
def validated_requests(spark, sf_dir):
    return validate_requests(_requests(flights(spark, sf_dir))).select("request_id", "error")


@register(over_flights("""
SELECT c.request_id, CASE WHEN c.error IS NULL THEN p.is_delayed END AS is_delayed,
       coalesce(c.error, CASE WHEN p.flight_number IS NULL THEN 'Aucune prédiction trouvée pour ce vol.' END) AS message
FROM checked c LEFT JOIN (
  SELECT * FROM predictions
  QUALIFY row_number() OVER (PARTITION BY flight_date, dep_hour, origin_airport, destination_airport
                             ORDER BY flight_number) = 1
) p ON c.flight_date = p.flight_date AND c.dep_hour = p.dep_hour AND upper(c.origin_airport) = p.origin_airport
   AND upper(c.destination_airport) = p.destination_airport
""", _CITY_SQL, _REQUESTS_SQL))
def lookup_predictions(spark, sf_dir):
    """Batch form of the prediction lookup."""
    rows = flights(spark, sf_dir)
    return prediction_lookup(_requests(rows), event_predictions(rows)).select("request_id", "is_delayed", "message")


_RUNS_SQL = """runs AS (
  SELECT CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failure' ELSE 'cancelled' END AS conclusion,
         ts AS created_at, CASE WHEN event_type <> 'view' THEN ts + to_seconds(CAST(floor(value) AS BIGINT)) END
           AS updated_at
  FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY
),
kpis AS (
  SELECT count(*) / 7.0::DOUBLE AS deployment_frequency,
         count(*) FILTER (conclusion = 'success') / count(*) * 100 AS deployment_success_rate,
         CAST(sum(epoch_us(updated_at) - epoch_us(created_at)) AS BIGINT) / 1000000.0::DOUBLE / count(updated_at)
           AS deployment_cycle_time_seconds,
         count(*) AS deployment_total,
         count(*) FILTER (conclusion = 'failure') AS deployment_failed
  FROM runs
)"""


def _kpis(spark, sf_dir):
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_type")
    ended = F.timestamp_add("SECOND", F.floor("value"), ts)
    runs = table(spark, sf_dir, "events").select(
        F.when(kind == "purchase", "success").when(kind == "error", "failure").otherwise("cancelled").alias(
            "conclusion"
        ),
        F.date_format(ts, iso).alias("created_at"),
        F.when(kind != "view", F.date_format(ended, iso)).alias("updated_at"),
    )
    return run_kpis(runs, F.timestamp_add("DAY", F.lit(-7), _newest_event(spark, sf_dir)))


@register("WITH " + _RUNS_SQL + " SELECT * FROM kpis")
def deployment_kpis(spark, sf_dir):
    """KPIs over the last week of runs."""
    return _kpis(spark, sf_dir)


@register("WITH " + _RUNS_SQL + """
SELECT name, '# TYPE ' || name || ' gauge' || chr(10) || name || ' ' || shown AS value FROM (
  SELECT unnest([
    {name: 'deployment_frequency', shown: CAST(round(deployment_frequency, 6) AS VARCHAR)},
    {name: 'deployment_success_rate', shown: CAST(round(deployment_success_rate, 6) AS VARCHAR)},
    {name: 'deployment_cycle_time_seconds', shown: CAST(round(deployment_cycle_time_seconds, 6) AS VARCHAR)},
    {name: 'deployment_total', shown: CAST(deployment_total AS VARCHAR)},
    {name: 'deployment_failed', shown: CAST(deployment_failed AS VARCHAR)}], recursive := true) FROM kpis)
""")
def metrics_text(spark, sf_dir):
    """The KPIs as exposition text, rounded."""
    kpis = _kpis(spark, sf_dir)
    rounded = kpis.select(
        [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in kpis.dtypes]
    )
    return exposition_lines(rounded)
