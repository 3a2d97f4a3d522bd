"""Jobs over a lake of their own, and scans that decide what to open, read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ...learning import classification_metrics
from ...operators import add_flight_features, add_snapshot_columns, drop_duplicates, head_rows, observed_head
from ...session import shared_folder
from ...sinks.lake import Lake
from ...sinks.snapshots import checked_batch
from ...sources import (
    flatten_weather,
    read_json_payload,
    read_weather_files,
    with_file_position,
)
from ..ingest import import_reference_codes
from ..kpis import publish_run_kpis
from ..learning import log_runs
from ..staging import cycle_ready, restage_flights
from .base import flights, over_flights, register, table
from .event_flights import event_raw_flights, event_weather, event_weather_documents

_DAY = dt.date(2024, 1, 10)


@register("""
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER () AS place FROM events
) QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY place DESC) = 1
""")
def dedupe_file_order(spark, sf_dir):
    """The row of each key that stands last in the file; no column tells the order."""
    rows = with_file_position(table(spark, sf_dir, "events")).where("value IS NOT NULL OR event_id >= 0")
    return drop_duplicates(rows, ["user_id", "event_type"], ["file_position"]).select(
        "user_id", "event_type", "event_id", "value"
    )


def _raw_lake(spark, sf_dir, purpose):
    """A lake whose raw flights are the events, as the source sends them."""
    lake = Lake.scratch(spark, purpose)
    lake.create("raw", "raw_flights")
    missing = {c: F.lit(None) for c in ("semaine_photo", "annee_photo", "instance_id", "dag_id")}
    rows = event_raw_flights(flights(spark, sf_dir)).withColumns(missing)
    lake.replace_partitions("raw", "raw_flights", rows)
    return lake, rows


@register(over_flights("""
SELECT flight_id, CAST(date AS VARCHAR) AS date, CAST(date_photo AS VARCHAR) AS date_photo, origin_airport,
       CASE WHEN date_photo = DATE '2024-01-10' AND origin_airport = 'NCE' THEN 'AGAIN' ELSE status END AS status,
       CASE wifi_enabled WHEN 'Y' THEN true WHEN 'N' THEN false END AS wifi_enabled,
       CASE WHEN event_id % 13 <> 0 THEN actual_departure END AS actual_departure,
       1 AS partitions_again
FROM flights WHERE date_photo <> DATE '2024-01-12'
"""))
def restaged_flights(spark, sf_dir):
    """Staging after one raw partition of many was loaded again and a day left the raw table: only that is read again."""
    lake, rows = _raw_lake(spark, sf_dir, "restaged")
    restage_flights(lake)
    changed = rows.where((F.col("date_photo") == F.lit(_DAY)) & (F.col("origin_airport") == "NCE"))
    lake.replace_partitions("raw", "raw_flights", changed.withColumn("status", F.lit("AGAIN")))
    lake.drop_partitions("raw", "raw_flights", lambda spec: spec["date_photo"] == "2024-01-12")
    again = restage_flights(lake)
    return lake.table("staging", "raw_flights").select(
        "flight_id", "date", "date_photo", "origin_airport", "status", "wifi_enabled", "actual_departure",
        F.lit(again).alias("partitions_again"),
    )


@register(over_flights("""
SELECT 'raw.raw_flights' AS table_name, a AS missing FROM (VALUES ('NCE'), ('LYS'), ('MRS'), ('TLS'), ('BOD')) e(a)
WHERE a NOT IN (SELECT origin_airport FROM flights WHERE execution_date BETWEEN TIMESTAMP '2024-01-20 10:00:00' AND TIMESTAMP '2024-01-20 12:00:00'
                AND event_id % 5 <> 2)
"""))
def cycle_gate(spark, sf_dir):
    """Airports that a raw table lacks in the two hours before a time; one of them has sent nothing."""
    lake = Lake.scratch(spark, "cycle_gate")
    lake.create("raw", "raw_flights")
    missing = {c: F.lit(None) for c in ("semaine_photo", "annee_photo", "instance_id", "dag_id")}
    rows = event_raw_flights(flights(spark, sf_dir)).withColumns(missing)
    until = F.lit("2024-01-20 12:00:00").cast("timestamp")
    lake.replace_partitions("raw", "raw_flights", rows.where((F.col("event_id") % 5 != 2) & (F.col("execution_date") <= until)))
    return cycle_ready(lake, [("raw", "raw_flights")], as_of=until)


@register(over_flights("""
SELECT CAST(date AS VARCHAR) AS date, airport_iata, temp_max, temp_mean, precipitation_hours, CAST(weather_code AS BIGINT) AS weather_code
FROM weather WHERE airport_iata IN ('NCE', 'TLS')
"""))
def weather_files(spark, sf_dir):
    """Weather of two airports from files of all: the file table decides which are opened."""
    path = shared_folder(spark, "weather_files")
    documents = event_weather_documents(event_weather(flights(spark, sf_dir)))
    documents.select(F.col("document").alias("value"), "airport_iata").write.partitionBy("airport_iata").text(path)
    found = read_weather_files(spark, path, airports=["NCE", "TLS"], multi_line=False)
    return flatten_weather(found).select("date", "airport_iata", "temp_max", "temp_mean", "precipitation_hours", "weather_code")


@register("""
SELECT 'iata_delay_codes' AS code_table, p_partkey AS id, p_name || chr(10) || '"' || p_type || '"' AS description, '' AS replaced_again
FROM part WHERE p_partkey <= 200
UNION ALL
SELECT 'weather_codes', n_nationkey, upper(n_name) || ', ' || n_regionkey, 'weather_codes' FROM nation
""")
def reference_codes(spark, sf_dir):
    """Code tables from files: the second import replaces only the one whose file has changed."""
    lake, path = Lake.scratch(spark, "reference_codes"), shared_folder(spark, "code_files")
    codes = table(spark, sf_dir, "part").where("p_partkey <= 200").select(
        F.col("p_partkey").alias("id"), F.substring("p_brand", 1, 2).alias("code"), F.col("p_type").alias("title"),
        F.concat("p_name", F.lit('\n"'), "p_type", F.lit('"')).alias("description"),
    )
    nations = table(spark, sf_dir, "nation")
    named = nations.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("description"))
    other = nations.select(F.col("n_nationkey").alias("code"), F.concat(F.upper("n_name"), F.lit(", "), "n_regionkey").alias("description"))
    for name, df in (("iata", codes), ("weather", named), ("changed", other)):
        df.write.csv(f"{path}/{name}", header=True, quote='"', escape='"', quoteAll=True)
    import_reference_codes(lake, f"{path}/iata", f"{path}/weather")
    replaced = import_reference_codes(lake, f"{path}/iata", f"{path}/changed")
    parts = [
        lake.table("ref", name).select(
            F.lit(name).alias("code_table"), F.col(key).alias("id"), "description",
            F.lit(name if name in replaced else "").alias("replaced_again"),
        )
        for name, key in (("iata_delay_codes", "id"), ("weather_codes", "code"))
    ]
    return parts[0].unionByName(parts[1])


@register(over_flights("""
SELECT 'rule-' || origin_airport AS run_id, 'rules' AS experiment, 'rule' AS model, origin_airport AS origin,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1
FROM (SELECT origin_airport, count(*) FILTER (is_delayed AND k % 2 = 0) AS tp, count(*) FILTER (NOT is_delayed AND k % 2 = 0) AS fp,
             count(*) FILTER (is_delayed AND k % 2 = 1) AS fn FROM flagged GROUP BY origin_airport)
"""))
def run_log(spark, sf_dir):
    """The log of one run per origin, logged twice as by a retry."""
    lake = Lake.scratch(spark, "run_log")
    rows = add_flight_features(flights(spark, sf_dir)).withColumn("guess", F.col("k") % 2 == 0)
    metrics = classification_metrics(rows, "is_delayed", "guess", by=["origin_airport"])
    runs = metrics.select(
        F.concat(F.lit("rule-"), "origin_airport").alias("run_id"),
        F.lit("rule").alias("model"),
        F.create_map(F.lit("origin"), F.col("origin_airport")).alias("params"),
        F.create_map(F.lit("f1"), F.col("f1").cast("double")).alias("metrics"),
        F.lit("2024-02-01 06:00:00").cast("timestamp").alias("logged_at"),
        F.lit("rules").alias("experiment"),
    )
    for _ in range(2):
        log_runs(lake, runs)
    log = lake.table("ml", "runs")
    return log.select("run_id", "experiment", "model", F.col("params.origin").alias("origin"), F.round("metrics.f1", 6).alias("f1"))


@register("""
SELECT o_orderkey, o_totalprice, o_orderstatus, (SELECT count(*) FROM orders) AS rows_written FROM (
  SELECT *, row_number() OVER () AS place FROM orders) WHERE place <= 5
""")
def observed_preview(spark, sf_dir):
    """The first five rows, as seen while the table was written."""
    path = shared_folder(spark, "preview")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").coalesce(1)
    seen, observation = observed_head(orders, 5)
    counted = Observation("rows")
    seen.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return head_rows(orders, observation).withColumn("rows_written", F.lit(counted.get["n"]))


@register(over_flights("""
SELECT flight_id, CAST(coalesce(CAST(actual_departure AS DATE), CAST(scheduled_arrival AS DATE), DATE '2024-02-02') AS VARCHAR) AS date_photo,
       weekofyear(coalesce(CAST(actual_departure AS DATE), CAST(scheduled_arrival AS DATE), DATE '2024-02-02')) AS semaine_photo
FROM (SELECT * REPLACE (CASE WHEN event_id % 22 <> 0 THEN scheduled_arrival END AS scheduled_arrival) FROM flights)
"""))
def stamped_fallbacks(spark, sf_dir):
    """The load time is the first one known of three: some rows lack the first, some the first two."""
    rows = flights(spark, sf_dir)
    second = F.when(F.col("event_id") % 22 != 0, F.col("scheduled_arrival"))
    out = add_snapshot_columns(rows.drop("date_photo", "execution_date"), "d", "r", F.col("actual_departure"), second, dt.datetime(2024, 2, 2))
    return out.select("flight_id", "date_photo", "semaine_photo")


@register(over_flights("""
SELECT flight_id, CAST(date_photo AS VARCHAR) AS date_photo, origin_airport FROM flights WHERE date_photo = DATE '2024-01-10'
"""))
def batch_checks(spark, sf_dir):
    """A batch with its checks built in: they let a whole batch through and read it once."""
    batch = flights(spark, sf_dir).where(F.col("date_photo") == F.lit(_DAY)).select("flight_id", "date_photo", "origin_airport")
    return checked_batch(batch, _DAY, "origin_airport")


@register("""
SELECT user_id % 7 AS class, count(*) AS events, max(value) AS largest FROM events GROUP BY 1
""")
def json_payload(spark, sf_dir):
    """One JSON document per file, several files; a folder that is not there adds nothing."""
    path, schema = shared_folder(spark, "payload"), "class bigint, events bigint, largest double"
    classes = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 7).alias("class"))
    documents = classes.agg(F.count("*").alias("events"), F.max("value").alias("largest"))
    documents = documents.select(F.col("class").alias("file"), F.to_json(F.struct("class", "events", "largest")).alias("value"))
    documents.write.partitionBy("file").text(path)
    return read_json_payload(spark, f"{path}/file=*", schema).unionByName(read_json_payload(spark, f"{path}-none", schema))


@register("""
SELECT '# TYPE deployment_' || name || ' gauge' AS line FROM (VALUES ('frequency'), ('success_rate'), ('cycle_time_seconds'), ('total'), ('failed')) t(name)
UNION ALL SELECT 'deployment_total ' || count(*) FROM events
UNION ALL SELECT 'deployment_failed ' || count(*) FILTER (event_type = 'error') FROM events
""")
def kpi_file(spark, sf_dir):
    """KPIs as a text file for a scraper, read back; the ratios are compared elsewhere."""
    path = shared_folder(spark, "kpi_file")
    iso, ts = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", F.col("ts").cast("timestamp")
    kind = F.when(F.col("event_type") == "error", "failure").otherwise("success")
    stamp = F.date_format(ts, iso)
    publish_run_kpis(
        table(spark, sf_dir, "events").select(kind.alias("conclusion"), stamp.alias("created_at"), stamp.alias("updated_at")),
        path, F.lit("2000-01-01").cast("timestamp"),
    )
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    return lines.where("line LIKE '#%' OR line LIKE 'deployment_total %' OR line LIKE 'deployment_failed %'")
