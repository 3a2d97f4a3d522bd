"""Writes, read back: snapshots, upserts, updates and files in the shared folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ...functions import clip_and_round
from ...operators import add_flight_features
from ...session import shared_folder
from ...sinks.files import write_by_key, write_csv, write_parquet
from ...sinks.lake import Lake
from ...sinks.snapshots import replace_snapshots, snapshot_replace
from ...sinks.tables import load_table
from ...sinks.upserts import reconcile_table, update_minutes_table, upsert_predictions_table
from ...sources.files import read_csv, read_parquet
from ...sources.tables import incremental_scan
from .base import flights, over_flights, register, table
from .event_flights import event_predictions

_DDL = "flight_id string, status string, k int, date_photo date, origin_airport string"
_PARTITIONS = ("date_photo", "origin_airport")
_DAY = dt.date(2024, 1, 10)


def _loaded_lake(spark, sf_dir, purpose):
    """A lake with a snapshot table holding every flight, and the flights."""
    lake = Lake.scratch(spark, purpose)
    lake.create("staging", "event_flights", _DDL, _PARTITIONS)
    rows = flights(spark, sf_dir).select("flight_id", "status", "k", "date_photo", "origin_airport")
    replace_snapshots(lake, rows, "staging", "event_flights")
    return lake, rows


def _second_batch(rows):
    """One day again for two airports, with other values."""
    return rows.filter((F.col("date_photo") == F.lit(_DAY)) & F.col("origin_airport").isin("NCE", "LYS")).withColumn(
        "k", F.col("k") + 1000
    )


_REPLACED = "date_photo {} DATE '2024-01-10' AND origin_airport IN ('NCE', 'LYS')"


def _snapshot_sql(comparison: str, only_watermark: bool = False) -> str:
    condition = " WHERE date_photo = '2024-01-10'" if only_watermark else ""
    return over_flights(f"""
SELECT * FROM (
  SELECT flight_id, status, k, CAST(date_photo AS VARCHAR) AS date_photo, origin_airport FROM flights
  WHERE NOT ({_REPLACED.format(comparison)})
  UNION ALL
  SELECT flight_id, status, k + 1000, CAST(date_photo AS VARCHAR), origin_airport FROM flights
  WHERE {_REPLACED.format('=')}
){condition}""")


@register(_snapshot_sql("="))
def snapshot_replace_raw(spark, sf_dir):
    """A day loaded again for two airports replaces just that."""
    lake, rows = _loaded_lake(spark, sf_dir, "snapshot_raw")
    snapshot_replace(lake, _second_batch(rows), "staging", "event_flights", "raw", date_photo=_DAY)
    return lake.table("staging", "event_flights")


@register(_snapshot_sql("<="))
def snapshot_replace_scheduled(spark, sf_dir):
    """A schedule load also removes the earlier days of its airports."""
    lake, rows = _loaded_lake(spark, sf_dir, "snapshot_scheduled")
    snapshot_replace(lake, _second_batch(rows), "staging", "event_flights", "scheduled", date_photo=_DAY)
    return lake.table("staging", "event_flights")


@register(_snapshot_sql("=", only_watermark=True))
def incremental_snapshot(spark, sf_dir):
    """Only the snapshot the watermark names."""
    lake, rows = _loaded_lake(spark, sf_dir, "incremental")
    snapshot_replace(lake, _second_batch(rows), "staging", "event_flights", "raw", date_photo=_DAY)
    return incremental_scan(lake, "staging", "event_flights")


@register(over_flights("""
SELECT flight_id, k, CAST(date_photo AS VARCHAR) AS date_photo FROM flights WHERE date_photo <> DATE '2024-01-10'
UNION ALL SELECT flight_id, -k, CAST(date_photo AS VARCHAR) FROM flights WHERE date_photo = DATE '2024-01-10'
"""))
def snapshot_by_date(spark, sf_dir):
    """Replacement of a whole day, whatever its airports."""
    lake = Lake.scratch(spark, "snapshot_by_date")
    lake.create("raw", "event_days", "flight_id string, k int, date_photo date", ("date_photo",))
    rows = flights(spark, sf_dir).select("flight_id", "k", "date_photo")
    lake.replace_partitions("raw", "event_days", rows)
    again = rows.filter(F.col("date_photo") == F.lit(_DAY)).withColumn("k", -F.col("k"))
    snapshot_replace(lake, again, "raw", "event_days", airport_column=None)
    return lake.table("raw", "event_days")


def _scored_rows(rows):
    """Prediction rows by rule, one per flight, many per key."""
    features = add_flight_features(rows, scheduled=True)
    return features.select(
        "flight_number",
        F.col("date").alias("flight_date"),
        "dep_hour",
        "origin_airport",
        "destination_airport",
        "departure_time_block",
        "day_of_week",
        "month",
        "is_cancelled",
        (F.col("k") % 2 == 0).alias("is_delayed"),
        F.col("execution_date").alias("prediction_date"),
        F.concat(F.lit("run-"), F.col("event_id")).alias("run_id"),
        F.concat(F.lit("m"), F.col("k") % 3).alias("model_name"),
        F.col("k").cast("string").alias("model_version"),
        "execution_date",
        "flight_id",
        "event_id",
    )


_ORDER = ("execution_date", "flight_id")

_UPSERTED_SQL = """upserted AS (
  SELECT flight_number, date AS flight_date,
         last(dep_hour ORDER BY o) AS dep_hour,
         first(origin_airport ORDER BY o) AS origin_airport,
         first(departure_time_block ORDER BY o) AS departure_time_block,
         first(is_cancelled ORDER BY o) AS is_cancelled,
         last(k % 2 = 0 ORDER BY o) AS is_delayed,
         last(execution_date ORDER BY o) AS prediction_date,
         last('run-' || event_id ORDER BY o) AS run_id,
         last('m' || (k % 3) ORDER BY o) AS model_name
  FROM (SELECT *, row_number() OVER (ORDER BY event_id % 2, execution_date, flight_id) AS o FROM flagged)
  GROUP BY flight_number, date
)"""


def _upserted_lake(spark, sf_dir, purpose):
    lake = Lake.scratch(spark, purpose)
    rows = _scored_rows(flights(spark, sf_dir))
    for part in (0, 1):
        upsert_predictions_table(lake, rows.filter(F.col("event_id") % 2 == part), _ORDER)
    return lake


@register(over_flights("""
SELECT flight_number, CAST(flight_date AS VARCHAR) AS flight_date, CAST(dep_hour AS BIGINT) AS dep_hour, origin_airport,
       departure_time_block, is_cancelled, is_delayed, prediction_date, run_id, model_name
FROM upserted
""", _UPSERTED_SQL))
def upsert_predictions(spark, sf_dir):
    """Two batches of predictions: the second updates known flights and adds new ones."""
    return _upserted_lake(spark, sf_dir, "upsert").table("ml", "flight_predictions").select(
        "flight_number", "flight_date", "dep_hour", "origin_airport", "departure_time_block", "is_cancelled",
        "is_delayed", "prediction_date", "run_id", "model_name",
    )


@register(over_flights("""
SELECT u.flight_number, CAST(u.flight_date AS VARCHAR) AS flight_date, u.origin_airport, u.is_delayed,
       s.minutes AS predicted_delay_minutes, CASE WHEN s.minutes IS NOT NULL THEN 'rule' END AS regression_model_name
FROM upserted u LEFT JOIN (
  SELECT flight_number, origin_airport, round_even(greatest(value - 10, 0), 1) AS minutes FROM flights
  QUALIFY row_number() OVER (PARTITION BY flight_number, origin_airport ORDER BY execution_date DESC, flight_id DESC) = 1
) s ON u.flight_number = s.flight_number AND u.origin_airport = s.origin_airport AND u.is_delayed
   AND u.flight_date = DATE '2024-01-15'
""", _UPSERTED_SQL))
def update_minutes(spark, sf_dir):
    """Predicted minutes for the flights of one day that are expected late."""
    lake = _upserted_lake(spark, sf_dir, "minutes")
    scores = flights(spark, sf_dir).select(
        "flight_number",
        "origin_airport",
        clip_and_round(F.col("value") - 10).alias("predicted_delay_minutes"),
        *_ORDER,
    )
    update_minutes_table(lake, scores, dt.date(2024, 1, 15), "rule", "1", _ORDER)
    return lake.table("ml", "flight_predictions").select(
        "flight_number", "flight_date", "origin_airport", "is_delayed", "predicted_delay_minutes",
        "regression_model_name",
    )


@register(over_flights("""
SELECT f.flight_id, p.is_delayed AS is_delayed_predicted
FROM flights f LEFT JOIN predictions p
  ON f.flight_number = p.flight_number AND f.date = p.flight_date AND f.origin_airport = p.origin_airport
"""))
def reconcile_stored(spark, sf_dir):
    """Reconciliation of a stored table in place."""
    lake = Lake.scratch(spark, "reconcile")
    rows = flights(spark, sf_dir)
    lake.create(
        "analytics",
        "event_flights",
        "flight_id string, flight_number string, date date, is_delayed_predicted boolean, date_photo date,"
        " origin_airport string",
        _PARTITIONS,
    )
    lake.replace_partitions(
        "analytics", "event_flights", rows.withColumn("is_delayed_predicted", F.lit(None).cast("boolean"))
    )
    reconcile_table(lake, event_predictions(rows), "event_flights")
    return lake.table("analytics", "event_flights").select("flight_id", "is_delayed_predicted")


@register("SELECT event_type, event_id, value FROM events")
def multi_output(spark, sf_dir):
    """One folder per key, read back."""
    path = shared_folder(spark, "multi_output")
    write_by_key(table(spark, sf_dir, "events").select("event_id", "value", "event_type"), path, "event_type")
    return read_parquet(spark, path, "event_id bigint, value double, event_type string", require_file=True)


@register(over_flights("SELECT flight_number, is_delayed FROM predictions"))
def predictions_csv(spark, sf_dir):
    """Predictions as CSV, read back."""
    path = shared_folder(spark, "predictions_csv")
    write_csv(event_predictions(flights(spark, sf_dir)).select("flight_number", "is_delayed"), path)
    return read_csv(spark, path, "flight_number string, is_delayed boolean")


@register("SELECT doc_id, text, lang FROM documents")
def csv_texts(spark, sf_dir):
    """Whole texts with quotes and line breaks through CSV and back."""
    path = shared_folder(spark, "csv_texts")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    documents.write.csv(path, header=True, quote='"', escape='"', quoteAll=True)
    return read_csv(spark, path, "doc_id bigint, text string, lang string", multi_line=True)


@register("SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, -o_totalprice FROM orders")
def table_load(spark, sf_dir):
    """Replace, then append."""
    lake = Lake.scratch(spark, "table_load")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    load_table(orders, lake.name("raw", "orders"), "replace")
    load_table(orders.withColumn("o_totalprice", -F.col("o_totalprice")), lake.name("raw", "orders"), "append")
    return lake.table("raw", "orders")


@register("SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice < 0")
def empty_parquet(spark, sf_dir):
    """An empty result keeps its schema on disk."""
    path = shared_folder(spark, "empty_parquet")
    write_parquet(table(spark, sf_dir, "orders").filter("o_totalprice < 0").select("o_orderkey", "o_custkey"), path)
    return read_parquet(spark, path, "o_orderkey bigint, o_custkey bigint", require_file=True)
