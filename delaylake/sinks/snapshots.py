"""Idempotent snapshot replacement (K2-K5)."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.joins import checked_broadcast
from ..operators.quality import observed
from ..session import written
from .lake import Lake

logger = logging.getLogger(__name__)


def _checked(c: Column, condition: Column, message: str) -> Column:
    return F.when(condition, c).otherwise(F.raise_error(F.lit(message)))


def checked_batch(batch: DataFrame, date_photo: dt.date, airport_column: str | None = None) -> DataFrame:
    """The batch with its checks built in: one snapshot date, and an airport on every row.

    The checks run inside the write job. A row that breaks them fails the job before anything is
    published, so the batch is read once instead of once to check and once to load.
    """
    if "date_photo" not in batch.columns:
        raise ValueError("the batch has no column date_photo")
    day = F.lit(date_photo.isoformat()).cast("date")
    found = F.col("date_photo").cast("date")
    batch = batch.withColumn(
        "date_photo",
        _checked(found, found.eqNullSafe(day), f"the batch holds another date_photo than {date_photo}"),
    )
    if airport_column:
        airport = F.col(airport_column)
        batch = batch.withColumn(
            airport_column, _checked(airport, airport.isNotNull(), f"the batch holds a NULL {airport_column}")
        )
    return batch


def batch_date(batch: DataFrame) -> dt.date | None:
    """Snapshot date of the first row, None for an empty batch; ``checked_batch`` holds the rest to it."""
    row = batch.select(F.col("date_photo").cast("date")).first()
    if row is None:
        return None
    if row[0] is None:
        raise ValueError("the batch holds a NULL date_photo")
    return row[0]


def snapshot_replace(
    lake: Lake,
    batch: DataFrame,
    layer: str,
    table: str,
    mode: str = "raw",
    airport_column: str | None = "origin_airport",
    date_photo: dt.date | None = None,
    null_alarm: float | None = None,
    notes: dict[str, str] | None = None,
) -> int:
    """Replace a snapshot and advance the watermark, in one commit; returns the rows loaded.

    Columns with more than ``null_alarm`` percent of NULL are logged as a warning; the write counts them.

    The table is partitioned by (date_photo, airport), or by date_photo alone with
    ``airport_column=None``. Mode ``raw`` replaces the batch's own date for the batch's airports; mode
    ``scheduled`` also removes their earlier dates. Both work on whole partitions only. An empty batch
    changes nothing. Running twice gives the same table as running once. ``notes`` are kept with the version.
    """
    if mode not in ("raw", "scheduled"):
        raise ValueError(f"unknown mode {mode!r}")
    if "date_photo" not in batch.columns:
        raise ValueError("the batch has no column date_photo")
    if date_photo is None:
        date_photo = batch_date(batch)
        if date_photo is None:
            logger.info("empty batch for %s.%s", layer, table)
            return 0
    checked = checked_batch(batch, date_photo, airport_column)
    return _publish(lake, checked, layer, table, mode, airport_column, null_alarm, notes)


def replace_snapshots(
    lake: Lake, batch: DataFrame, layer: str, table: str, mode: str = "raw", airport_column: str = "origin_airport"
) -> int:
    """Replace several snapshots in one write, with the outcome of loading their dates oldest first.

    In mode ``scheduled`` every date removes the earlier ones of its airports, so only the newest date
    of each airport is written.
    """
    date, airport = F.col("date_photo").cast("date"), F.col(airport_column)
    batch = batch.withColumns(
        {
            "date_photo": _checked(date, date.isNotNull(), "the batch holds a NULL date_photo"),
            airport_column: _checked(airport, airport.isNotNull(), f"the batch holds a NULL {airport_column}"),
        }
    )
    if mode == "scheduled":
        # One row per airport.
        newest = batch.groupBy(airport_column).agg(F.max("date_photo").alias("newest"))
        batch = (
            batch.join(checked_broadcast(written(newest, "newest")), airport_column)
            .filter(F.col("date_photo") == F.col("newest"))
            .drop("newest")
        )
    return _publish(lake, batch, layer, table, mode, airport_column)


def _publish(
    lake: Lake, batch: DataFrame, layer: str, table: str, mode: str, airport_column: str | None,
    null_alarm: float | None = None, notes: dict[str, str] | None = None,
) -> int:
    lake.create(layer, table)
    metrics = [F.count(F.lit(1)).alias("rows"), F.max("date_photo").cast("string").alias("newest")]
    if airport_column and mode == "scheduled":
        # One value per airport and date: bounded by partitions, not by rows.
        metrics.append(
            F.collect_set(F.concat_ws("|", F.col("date_photo").cast("string"), airport_column)).alias("snapshots")
        )
    checked = batch.columns if null_alarm is not None else []
    metrics += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(checked)]
    observation = Observation(f"load {layer}.{table}")
    written = lake.write(layer, table, batch.observe(observation, *metrics))
    seen = observed(observation, batch, metrics)
    if seen["rows"] == 0:
        return 0
    for i, c in enumerate(checked):
        percent = round(100 * seen[f"nulls_{i}"] / seen["rows"], 2)
        if percent > null_alarm:
            logger.warning("%s.%s: %s is NULL in %s %% of %s rows", layer, table, c, percent, seen["rows"])
    superseded = None
    if mode == "scheduled":
        newest = {a: d for d, a in (s.split("|", 1) for s in sorted(seen["snapshots"]))} if airport_column else {}
        limit = (lambda spec: newest.get(spec[airport_column], "")) if airport_column else (lambda spec: seen["newest"])
        superseded = lambda spec: spec["date_photo"] < limit(spec)
    # New partitions, removed ones and the watermark: one step.
    lake.commit(layer, table, written, superseded, seen["newest"], notes=notes)
    return seen["rows"]
