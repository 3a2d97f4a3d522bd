"""Landed files to raw tables."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..operators.columns import add_snapshot_columns
from ..operators.quality import observed
from ..sinks.lake import Lake
from ..sinks.snapshots import snapshot_replace
from ..sinks.tables import load_table
from ..sources.documents import flatten_flights, flatten_weather
from ..sources.discovery import content_digest
from ..sources.files import read_reference_codes
from ..sources.windows import on_route, reference_day

logger = logging.getLogger(__name__)

_TABLE_OF_MODE = {"raw": "raw_{}", "scheduled": "scheduled_{}"}


def load_flights(
    lake: Lake, documents: DataFrame, mode: str, logical_date: dt.datetime, dag_id: str, run_id: str
) -> int:
    """Flight documents of all airports to the raw layer in one job; returns rows loaded.

    Loaded are flights scheduled within the reference day; ``_load`` tells what becomes of others.
    """
    return _load(lake, on_route(flatten_flights(documents)), "flights", mode, "origin_airport", logical_date, dag_id, run_id)


def load_weather(
    lake: Lake, documents: DataFrame, mode: str, logical_date: dt.datetime, dag_id: str, run_id: str
) -> int:
    """Weather documents of all airports to the raw layer in one job; returns rows loaded."""
    return _load(lake, flatten_weather(documents), "weather", mode, "airport_iata", logical_date, dag_id, run_id)


def _load(
    lake: Lake, parsed: DataFrame, kind: str, mode: str, airport_column: str, logical_date: dt.datetime, dag_id: str, run_id: str
) -> int:
    """Rows of the reference day to their table; the load counts the rest, and keeps them in ``ops.quarantine``.

    A row whose date cannot be read, or is of another day, does not vanish: its text goes to the quarantine
    partition of this table and snapshot, which a repeated load replaces.
    """
    table = _TABLE_OF_MODE[mode].format(kind)
    day = F.lit(reference_day(logical_date.date(), mode).isoformat()).cast("date")
    date = F.col("date").try_cast("date")
    wanted = F.coalesce(date == day, F.lit(False))
    counts = [F.count_if(date.isNull()).alias("unreadable"), F.count_if(date != day).alias("other_day")]
    observation = Observation(f"dates of {table}")
    # Documents are parsed once, for the table and for the quarantine; kept on disk, as a load may be larger than memory.
    parsed = parsed.persist(StorageLevel.DISK_ONLY)
    try:
        rows = add_snapshot_columns(parsed, dag_id, run_id, logical_date)
        batch = rows.observe(observation, *counts).filter(wanted)
        loaded = snapshot_replace(lake, batch, "raw", table, mode, airport_column, logical_date.date())
        seen = observed(observation, rows, counts)
        if seen["unreadable"] or seen["other_day"]:
            logger.warning("%s: %s rows without a readable date, %s of another day", table, seen["unreadable"], seen["other_day"])
            lake.create("ops", "quarantine")
            reason = F.when(date.isNull(), "unreadable date").otherwise("another day")
            rejected = rows.filter(~wanted).select(
                reason.alias("reason"),
                F.to_json(F.struct(*[c for c in rows.columns if c != "date_photo"])).alias("content"),
                F.lit(f"raw.{table}").alias("load_table"),
                F.lit(logical_date.date().isoformat()).cast("date").alias("date_photo"),
            )
            lake.replace_partitions("ops", "quarantine", rejected)
    finally:
        parsed.unpersist()
    return loaded


def import_reference_codes(lake: Lake, iata_csv: str, weather_csv: str) -> list[str]:
    """Both code tables, replaced as a whole; a file whose content is that of the last import is skipped.

    The digest of the content is kept with the table, noted after the load: an import that ends in between is repeated.
    Returns the tables replaced.
    """
    replaced = []
    for kind, path, table in (("iata", iata_csv, "iata_delay_codes"), ("weather", weather_csv, "weather_codes")):
        name, digest = lake.name("ref", table), content_digest(lake.spark, path)
        if lake.exists("ref", table):
            known = {r.key: r.value for r in lake.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
            if known.get(_DIGEST) == digest:
                logger.info("ref.%s is unchanged", table)
                continue
        load_table(read_reference_codes(lake.spark, path, kind), name, "replace")
        lake.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_DIGEST}' = '{digest}')")
        replaced.append(table)
    return replaced


_DIGEST = "delaylake.source.digest"
