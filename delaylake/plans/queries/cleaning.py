"""Casts, filters, dedupe, quality and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ...functions import (
    array_to_braces,
    bool_map,
    braces_to_value,
    clip_and_round,
    map_value,
    normalised_code,
    to_calendar_date,
    to_integer,
    to_text,
    to_utc_timestamp,
)
from ...operators import (
    best_of,
    best_tag,
    count_stage,
    delayed_with_target,
    distinct_sorted,
    drop_columns,
    drop_duplicates,
    except_rows,
    filter_landed,
    filter_pending,
    first_match,
    intersect_rows,
    latest_version,
    missing_values,
    null_profile,
    prediction_mix,
    readiness,
    recent,
    rename_columns,
    require_min_rows,
    select_features,
    sort_nulls_last,
    union_by_name,
)
from ...operators.enrich import add_flight_features
from ...sources.windows import in_reference_day, on_route
from .base import flights, over_flights, register, table


def _newest_event(spark, sf_dir):
    """Largest event time as a literal; one value travels to the driver."""
    micros = table(spark, sf_dir, "events").agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()[0]
    return F.timestamp_micros(F.lit(micros))


@register(over_flights("SELECT flight_id, try_cast(trim(delay_code, '{}') AS BIGINT) AS code FROM flights"))
def parse_code_int(spark, sf_dir):
    """Array text to number; several codes give NULL."""
    return flights(spark, sf_dir).select("flight_id", braces_to_value(F.col("delay_code")).alias("code"))


@register(over_flights("SELECT flight_id, nullif(trim(delay_code, '{}'), '') AS code FROM flights"))
def parse_code_str(spark, sf_dir):
    """Array text to its content."""
    return flights(spark, sf_dir).select("flight_id", braces_to_value(F.col("delay_code"), "str").alias("code"))


@register(over_flights("""
SELECT flight_id, split_part(nullif(trim(delay_code, '{}'), ''), ',', 1) AS code FROM flights
"""))
def parse_code_first(spark, sf_dir):
    """First code of the array text."""
    return flights(spark, sf_dir).select("flight_id", braces_to_value(F.col("delay_code"), "first").alias("code"))


@register(over_flights("SELECT flight_id, delay_code AS braces FROM flights"))
def array_text(spark, sf_dir):
    """Array text to an array and back."""
    values = braces_to_value(F.col("delay_code"), "array")
    return flights(spark, sf_dir).select("flight_id", array_to_braces(values).alias("braces"))


@register(over_flights("""
SELECT flight_id, CASE event_id % 7 WHEN 0 THEN NULL
  WHEN 1 THEN date_trunc('second', execution_date) - INTERVAL 1 HOUR
  WHEN 2 THEN NULL ELSE execution_date END AS parsed
FROM flights
"""))
def safe_timestamp(spark, sf_dir):
    """Junk, an offset, NULL and UTC times in one text column."""
    ts, kind = F.col("execution_date"), F.col("event_id") % 7
    text = (
        F.when(kind == 0, "not_a_date")
        .when(kind == 1, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00")))
        .when(kind > 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return flights(spark, sf_dir).select("flight_id", to_utc_timestamp(text).alias("parsed"))


@register(over_flights("""
SELECT flight_id, CASE event_id % 5 WHEN 0 THEN NULL ELSE CAST(date AS VARCHAR) END AS parsed FROM flights
"""))
def safe_date(spark, sf_dir):
    """Calendar dates from dates, times and junk."""
    kind, date = F.col("event_id") % 5, F.col("date").cast("string")
    text = F.when(kind == 0, "2024-13-45").when(kind == 1, F.concat(date, F.lit("T23:30:00+01:00"))).otherwise(date)
    return flights(spark, sf_dir).select("flight_id", to_calendar_date(text).alias("parsed"))


@register(over_flights("""
SELECT flight_id, CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN k * 1000 WHEN 3 THEN NULL
  ELSE k END AS parsed
FROM flights
"""))
def safe_int(spark, sf_dir):
    """Numbers as text: the word null, junk, exponents, fractions, blanks around."""
    kind, k = F.col("event_id") % 6, F.col("k").cast("string")
    text = (
        F.when(kind == 0, "null")
        .when(kind == 1, F.concat(k, F.lit("x")))
        .when(kind == 2, F.concat(k, F.lit("e3")))
        .when(kind == 3, F.concat(k, F.lit(".5")))
        .when(kind == 4, F.concat(F.lit(" "), k, F.lit(" ")))
        .otherwise(k)
    )
    return flights(spark, sf_dir).select("flight_id", to_integer(text).alias("parsed"))


@register(over_flights("""
SELECT flight_id, CASE wifi_enabled WHEN 'Y' THEN true WHEN 'N' THEN false END AS wifi FROM flights
"""))
def mapped_bool(spark, sf_dir):
    """Y/N flags to booleans."""
    return flights(spark, sf_dir).select(
        "flight_id", bool_map(F.col("wifi_enabled"), {"Y": True, "N": False}).alias("wifi")
    )


@register(over_flights("""
SELECT flight_id, status AS as_text, coalesce(status, 'None') AS spelled_out, CAST(k AS VARCHAR) AS number_text,
       upper(trim('  ' || lower(origin_airport) || ' ')) AS code
FROM flights
"""))
def text_forms(spark, sf_dir):
    """Text casts with and without spelled-out NULL, and code normalisation."""
    messy = F.concat(F.lit("  "), F.lower("origin_airport"), F.lit(" "))
    return flights(spark, sf_dir).select(
        "flight_id",
        to_text(F.col("status")).alias("as_text"),
        to_text(F.col("status"), "None").alias("spelled_out"),
        to_text(F.col("k")).alias("number_text"),
        normalised_code(messy).alias("code"),
    )


@register(over_flights("SELECT flight_id, actual_arrival FROM flights WHERE actual_arrival IS NOT NULL"))
def landed_flights(spark, sf_dir):
    return filter_landed(flights(spark, sf_dir)).select("flight_id", "actual_arrival")


@register(over_flights("SELECT flight_id, scheduled_arrival FROM flights WHERE actual_arrival IS NULL"))
def pending_flights(spark, sf_dir):
    return filter_pending(flights(spark, sf_dir)).select("flight_id", "scheduled_arrival")


@register(over_flights("SELECT flight_id, delay_minutes FROM flagged WHERE is_delayed AND delay_minutes IS NOT NULL"))
def regression_rows(spark, sf_dir):
    """Training rows of the delay regression, at least fifty of them."""
    delayed = delayed_with_target(add_flight_features(flights(spark, sf_dir)))
    return require_min_rows(delayed, 50, "delayed flights").select("flight_id", "delay_minutes")


@register("SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice FROM orders")
def drop_and_rename(spark, sf_dir):
    """Absent columns in the drop list are ignored."""
    kept = drop_columns(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus", "o_orderdate", "absent"])
    return rename_columns(kept, {"o_orderkey": "order_id", "o_custkey": "customer_id"})


@register("SELECT o_totalprice, o_orderkey FROM orders")
def feature_columns(spark, sf_dir):
    """Features the table has, in the order asked for."""
    return select_features(
        table(spark, sf_dir, "orders"), ["o_totalprice", "not_there", "o_orderkey"], lenient=True
    )


@register("""
SELECT o_orderkey, o_totalprice, NULL AS o_orderstatus FROM orders
UNION ALL SELECT o_orderkey, NULL, o_orderstatus FROM orders
""")
def union_missing_cols(spark, sf_dir):
    """Union by name, missing columns NULL."""
    orders = table(spark, sf_dir, "orders")
    return union_by_name(orders.select("o_orderkey", "o_totalprice"), orders.select("o_orderstatus", "o_orderkey"))


@register("""
SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000
""")
def except_keys(spark, sf_dir):
    rich = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000")
    return except_rows(table(spark, sf_dir, "customer").select("c_nationkey"), rich.select("s_nationkey"))


@register("SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def intersect_keys(spark, sf_dir):
    rich = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000")
    return intersect_rows(table(spark, sf_dir, "customer").select("c_nationkey"), rich.select("s_nationkey"))


@register(over_flights("""
SELECT flight_id, origin_airport, scheduled_departure FROM flights
WHERE origin_airport IN ('NCE', 'LYS') AND destination_airport = 'CDG' AND airline_code = 'AF'
  AND scheduled_departure >= TIMESTAMP '2024-01-10' AND scheduled_departure < TIMESTAMP '2024-01-11'
"""))
def route_window(spark, sf_dir):
    """Two origins, the day before the run."""
    rows = on_route(flights(spark, sf_dir), ["NCE", "LYS"])
    return in_reference_day(rows, "scheduled_departure", dt.date(2024, 1, 11), "raw").select(
        "flight_id", "origin_airport", "scheduled_departure"
    )


_LINE_KEY = ("l_orderkey", "l_linenumber")
_LINE_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus",
)


def _line_sql(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in _LINE_ORDER)
    return f"""SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"""


@register(_line_sql("DESC"))
def dedupe_last(spark, sf_dir):
    return drop_duplicates(table(spark, sf_dir, "lineitem"), _LINE_KEY, _LINE_ORDER, "last")


@register(_line_sql("ASC"))
def dedupe_first(spark, sf_dir):
    return drop_duplicates(table(spark, sf_dir, "lineitem"), _LINE_KEY, _LINE_ORDER, "first")


@register("SELECT * FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1")
def dedupe_none(spark, sf_dir):
    """Repeated keys go altogether."""
    return drop_duplicates(table(spark, sf_dir, "lineitem"), _LINE_KEY, (), False)


@register(over_flights("""
SELECT flight_number, CAST(date AS VARCHAR) AS date, origin_airport, flight_id,
       CAST(CASE WHEN k % 25 <> 0 THEN date_photo END AS VARCHAR) AS date_photo
FROM flights
QUALIFY row_number() OVER (PARTITION BY flight_number, date, origin_airport
  ORDER BY CASE WHEN k % 25 <> 0 THEN date_photo END DESC NULLS FIRST, execution_date DESC, flight_id DESC) = 1
"""))
def newest_version(spark, sf_dir):
    """Newest version per flight; a NULL version date wins."""
    rows = flights(spark, sf_dir).withColumn("date_photo", F.when(F.col("k") % 25 != 0, F.col("date_photo")))
    return latest_version(
        rows, ["flight_number", "date", "origin_airport"], "date_photo", ["execution_date", "flight_id"]
    ).select("flight_number", "date", "origin_airport", "flight_id", "date_photo")


_PROFILED = ("flight_id", "actual_arrival", "status", "wifi_enabled", "delay_code")


@register(over_flights("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
    f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS null_percent, "
    f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) > 20 AS breached FROM flights"
    for c in _PROFILED
)))
def null_rates(spark, sf_dir):
    """NULL profile of several columns in one pass."""
    return null_profile(flights(spark, sf_dir), _PROFILED, threshold_percent=20)


@register(over_flights("""
SELECT t.table_name, e.airport AS missing
FROM (VALUES ('NCE'), ('LYS'), ('MRS'), ('TLS'), ('BOD')) e(airport)
CROSS JOIN (VALUES ('flights'), ('landed')) t(table_name)
WHERE (t.table_name, e.airport) NOT IN (
  SELECT 'flights', origin_airport FROM flights
  WHERE event_id % 5 <> 3 AND execution_date >= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR
  UNION ALL
  SELECT 'landed', origin_airport FROM flights
  WHERE status = 'ARRIVED' AND execution_date >= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR)
"""))
def readiness_gate(spark, sf_dir):
    """Airports missing in the last two hours, per table."""
    landed = flights(spark, sf_dir).filter(F.col("status") == "ARRIVED")
    rows = flights(spark, sf_dir).filter("event_id % 5 <> 3")  # one airport has sent nothing
    return readiness(
        {"flights": (rows, "origin_airport"), "landed": (landed, "origin_airport")},
        as_of=_newest_event(spark, sf_dir),
    )


@register(over_flights("""
SELECT a AS origin_airport FROM (VALUES ('NCE'), ('LYS'), ('MRS'), ('TLS'), ('BOD')) e(a)
WHERE a NOT IN (SELECT origin_airport FROM flights WHERE event_id % 5 <> 3)
"""))
def missing_airports(spark, sf_dir):
    """Expected airports without a flight; one has sent nothing."""
    return missing_values(flights(spark, sf_dir).filter("event_id % 5 <> 3"), "origin_airport")


@register(over_flights("SELECT DISTINCT origin_airport, type_code FROM flights"))
def distinct_values(spark, sf_dir):
    return distinct_sorted(flights(spark, sf_dir), ["origin_airport", "type_code"])


@register(over_flights("""
SELECT flight_id, actual_arrival FROM flights ORDER BY actual_arrival ASC NULLS LAST, flight_id LIMIT 25
"""))
def earliest_arrivals(spark, sf_dir):
    """Sort with NULLs last, first 25."""
    return sort_nulls_last(flights(spark, sf_dir), ["actual_arrival", "flight_id"]).select(
        "flight_id", "actual_arrival"
    ).limit(25)


@register(over_flights("""
SELECT flight_number, flight_id FROM flights WHERE status = 'CANCELLED' ORDER BY flight_number, flight_id LIMIT 1
"""))
def first_cancelled(spark, sf_dir):
    return first_match(
        flights(spark, sf_dir), F.col("status") == "CANCELLED", ["flight_number", "flight_id"]
    ).select("flight_number", "flight_id")


@register(over_flights("""
SELECT count(*) AS num_predictions,
       round(count(*) FILTER (is_delayed) / count(*) * 100, 2) AS pct_delayed,
       round(count(*) FILTER (NOT is_delayed) / count(*) * 100, 2) AS pct_not_delayed
FROM flagged
"""))
def predicted_mix(spark, sf_dir):
    return prediction_mix(add_flight_features(flights(spark, sf_dir)))


_VERSIONS_SQL = """versions AS (
  SELECT origin_airport AS name, CAST(isodow(date) AS BIGINT) AS version,
         count(*) FILTER (is_delayed) / count(*) AS metric
  FROM flagged GROUP BY ALL
)"""


def _versions(spark, sf_dir):
    """A model version per origin and weekday, with a metric from the data."""
    return (
        add_flight_features(flights(spark, sf_dir))
        .groupBy(F.col("origin_airport").alias("name"), F.col("day_of_week").alias("version"))
        .agg((F.count_if("is_delayed") / F.count(F.lit(1))).alias("metric"))
    )


@register(over_flights("""
SELECT name, version, metric FROM versions
QUALIFY row_number() OVER (PARTITION BY name ORDER BY metric DESC, version) = 1
""", _VERSIONS_SQL))
def best_model(spark, sf_dir):
    """Version with the best metric per model."""
    return best_of(_versions(spark, sf_dir), "metric", "max", by=["name"], tie_break=["version"])


@register(over_flights("""
SELECT v.name, coalesce(max(round(metric, 4)) FILTER (version <= 3), 0) AS best FROM versions v GROUP BY v.name
""", _VERSIONS_SQL))
def best_tagged(spark, sf_dir):
    """Best value of a tag only some versions carry."""
    tagged = _versions(spark, sf_dir).withColumn(
        "tags",
        F.create_map(
            F.when(F.col("version") <= 3, "f1").otherwise("other"), F.round("metric", 4).cast("string")
        ),
    )
    return best_tag(tagged, "tags", "f1", "max", by=["name"])


@register("""
SELECT 'before' AS stage, count(*) AS row_count FROM lineitem
UNION ALL SELECT 'after', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
""")
def stage_counts(spark, sf_dir):
    """Rows before and after a dedupe, counted while it is written; this sink keeps nothing."""
    lines, before = count_stage(table(spark, sf_dir, "lineitem"), "before")
    single, after = count_stage(drop_duplicates(lines, _LINE_KEY, _LINE_ORDER), "after")
    single.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(
        [("before", before.get["rows"]), ("after", after.get["rows"])], "stage string, row_count bigint"
    )


@register(over_flights("""
SELECT flight_id, CASE status WHEN 'ARRIVED' THEN 'landed' ELSE status END AS shown FROM flights
"""))
def renamed_values(spark, sf_dir):
    """Values renamed by a map; others stay as they are."""
    return flights(spark, sf_dir).select("flight_id", map_value(F.col("status"), {"ARRIVED": "landed"}).alias("shown"))


@register(over_flights("SELECT flight_id, round_even(greatest(value - 10, 0), 1) AS minutes FROM flights"))
def clipped_minutes(spark, sf_dir):
    """Negative minutes become 0, the rest has one decimal, ties to even."""
    return flights(spark, sf_dir).select("flight_id", clip_and_round(F.col("value") - 10).alias("minutes"))


@register(over_flights("""
SELECT flight_id, execution_date FROM flights WHERE execution_date >= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR
"""))
def recent_flights(spark, sf_dir):
    """Flights loaded in the last two hours before the newest one."""
    return recent(flights(spark, sf_dir), as_of=_newest_event(spark, sf_dir)).select("flight_id", "execution_date")
