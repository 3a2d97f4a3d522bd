"""Streaming queries, run until everything landed is processed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ...operators import latest_version
from ...session import shared_folder
from ...sinks.lake import Lake
from ...streaming import batch_folder, coverage_stream, dedupe_stream, dropped_rows, file_stream, newest_stream, run_available, snapshot_stream
from .base import over_flights, register, table
from .event_flights import event_flights


_FILES = 6


def _event_stream(spark, sf_dir, max_files=None):
    """The events as several landed files, so that a date and airport lie in more than one of them."""
    events = table(spark, sf_dir, "events")
    path = shared_folder(spark, "landing")
    events.repartition(_FILES).write.parquet(path)
    return file_stream(spark, path, events.schema, "parquet", max_files)


@register(over_flights("""
SELECT flight_id, status, k, CAST(date_photo AS VARCHAR) AS date_photo, origin_airport FROM flights
"""))
def stream_ingest(spark, sf_dir):
    """Landed files, one per micro-batch, to a snapshot table."""
    lake = Lake.scratch(spark, "stream_ingest")
    lake.create(
        "raw",
        "event_flights",
        "flight_id string, status string, k int, date_photo date, origin_airport string",
        ("date_photo", "origin_airport"),
    )
    snapshot_stream(
        lake,
        _event_stream(spark, sf_dir, max_files=1),
        "raw",
        "event_flights",
        f"{lake.root}/checkpoint",
        prepare=lambda batch: event_flights(batch).select(
            "flight_id", "status", "k", "date_photo", "origin_airport"
        ),
    )
    return lake.table("raw", "event_flights")


@register("SELECT DISTINCT event_id, event_type, value FROM events")
def stream_dedupe(spark, sf_dir):
    """Every event sent twice, kept once.

    The late bound spans the whole time range, so no order of files makes a row too late.
    """
    path = shared_folder(spark, "stream_dedupe")
    once = _event_stream(spark, sf_dir)
    twice = once.unionByName(_event_stream(spark, sf_dir))
    single = dedupe_stream(twice, ["event_id"], "ts", "366 days").select("event_id", "event_type", "value")
    run_available(
        single,
        lambda batch, i: batch.write.mode("overwrite").parquet(batch_folder(f"{path}/rows", i)),
        f"{path}/checkpoint",
    )
    rows = spark.read.schema("event_id bigint, event_type string, value double, batch_id bigint").parquet(f"{path}/rows")
    return rows.drop("batch_id")


_STRAGGLERS = 40  # every so manieth event lands with the last file


def _file_of(event_id, ts):
    """Files hold five days each; some events come with the last one, most of them too late."""
    days = F.datediff(F.col(ts), F.lit("2024-01-01"))
    return F.when(F.col(event_id) % _STRAGGLERS == 0, 5).otherwise(F.least(F.floor(days / 5), F.lit(5))).cast("int")


@register("""
WITH landed AS (
  SELECT event_id, user_id, event_type, value, epoch_ms(ts) AS ms,
         CASE WHEN event_id % 40 = 0 THEN 5 ELSE least(5, datediff('day', DATE '2024-01-01', ts::DATE) // 5) END AS file
  FROM events
), marks AS (
  SELECT file, max(max(ms)) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 172800000 AS mark FROM landed GROUP BY file
), timed AS (
  SELECT l.*, coalesce(ms <= mark, false) AS late FROM landed l JOIN marks USING (file)
), spans AS (
  SELECT *, sum(CASE WHEN ms >= before + 28800000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY file, ms, event_id) AS span FROM (
    SELECT *, max(ms) OVER (PARTITION BY user_id ORDER BY file, ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
    FROM timed WHERE NOT late)
), newest AS (
  SELECT *, max(span) OVER (PARTITION BY user_id) AS last_span FROM spans
  QUALIFY row_number() OVER (PARTITION BY user_id, span ORDER BY ms DESC, event_id DESC) = 1
)
SELECT event_id, user_id, event_type, value, (SELECT count(*) FROM timed WHERE late) AS late_rows FROM newest
WHERE span < last_span OR ms + 28800000 <= (SELECT max(ms) - 172800000 FROM landed)
""")
def stream_newest(spark, sf_dir):
    """The last event of every user before eight quiet hours, as events land, and how many came later than two days."""
    landing, out = shared_folder(spark, "newest_landing"), shared_folder(spark, "stream_newest")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    for file in range(6):  # one after the other, as they would land
        events.where(_file_of("event_id", "ts") == file).coalesce(1).write.mode("append").parquet(landing)
    stream = file_stream(spark, landing, events.schema, "parquet", max_files=1)
    newest = newest_stream(stream, ["user_id"], "ts", "2 days", dt.timedelta(hours=8), F.col("event_id"))
    query = run_available(
        newest.drop("ts"),
        lambda batch, i: batch.write.mode("overwrite").parquet(batch_folder(f"{out}/rows", i)),
        f"{out}/checkpoint",
    )
    schema = "event_id bigint, user_id bigint, event_type string, value double, late boolean, batch_id bigint"
    rows = spark.read.schema(schema).parquet(f"{out}/rows").drop("batch_id")
    late = rows.where("late").count() + dropped_rows(query)
    return rows.where(~F.col("late")).drop("late").withColumn("late_rows", F.lit(late).cast("bigint"))


@register(over_flights("""
SELECT time_bucket(INTERVAL 2 HOUR, execution_date, TIMESTAMP '1970-01-01') AS window_start,
       concat_ws(',', CASE WHEN bool_or(origin_airport = 'NCE') THEN NULL ELSE 'NCE' END,
                      CASE WHEN bool_or(origin_airport = 'LYS') THEN NULL ELSE 'LYS' END,
                      CASE WHEN bool_or(origin_airport = 'MRS') THEN NULL ELSE 'MRS' END,
                      CASE WHEN bool_or(origin_airport = 'TLS') THEN NULL ELSE 'TLS' END,
                      CASE WHEN bool_or(origin_airport = 'BOD') THEN NULL ELSE 'BOD' END) AS missing,
       count(DISTINCT origin_airport) = 5 AS ready
FROM flights GROUP BY 1
"""))
def stream_coverage(spark, sf_dir):
    """Missing airports per two-hour window: every micro-batch writes the windows it changed, the newest counts."""
    path = shared_folder(spark, "stream_coverage")
    stream = event_flights(_event_stream(spark, sf_dir))
    coverage = coverage_stream(stream, "execution_date", "origin_airport", "2 hours").select(
        "window_start", F.array_join("missing", ",").alias("missing"), "ready"
    )
    run_available(
        coverage,
        lambda batch, i: batch.write.mode("overwrite").parquet(batch_folder(f"{path}/windows", i)),
        f"{path}/checkpoint",
        output_mode="update",
    )
    windows = spark.read.schema("window_start timestamp, missing string, ready boolean, batch_id bigint").parquet(
        f"{path}/windows"
    )
    return latest_version(windows, ["window_start"], "batch_id", []).drop("batch_id")
