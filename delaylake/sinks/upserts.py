"""Keyed updates of published tables; only touched partitions are rewritten, all in one commit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..constants import PREDICTION_KEY, PREDICTION_UPDATED_COLUMNS
from ..operators.quality import observed
from ..operators.reconcile import apply_minutes, reconcile
from ..session import written
from .lake import Lake
from .versions import NULL_VALUE


def merge_predictions(
    target: DataFrame,
    batch: DataFrame,
    order_by: Sequence[Column | str],
    key: Sequence[str] = PREDICTION_KEY,
    updated: Sequence[str] = PREDICTION_UPDATED_COLUMNS,
) -> DataFrame:
    """Insert new keys; for known keys replace the ``updated`` columns and keep all others.

    Same outcome as applying the batch row by row in ``order_by`` order: of several rows with one key,
    the last gives the updated columns and the first the kept ones. Rows with a NULL in the key never
    match anything and are added as they are.
    """
    target_columns = target.columns
    kept = [c for c in target_columns if c not in key and c not in updated and c in batch.columns]
    updated = [c for c in updated if c in batch.columns]
    has_key = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    position = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    collapsed = (
        batch.filter(has_key)
        .groupBy(*key)
        .agg(
            F.max_by(F.struct(*updated), position).alias("last"),
            F.min_by(F.struct(F.lit(True).alias("present"), *kept), position).alias("first"),
        )
    )
    in_batch = F.col("b.last").isNotNull()
    old = F.col("old")
    # Both sides have one row per key here: rows without key, however many, stay out of the shuffle.
    keyed = target.filter(has_key).withColumn("old", F.lit(True))
    joined = keyed.alias("t").join(collapsed.alias("b"), list(key), "full_outer")

    def value(name: str) -> Column:
        if name in key:
            return F.col(name)
        if name in updated:
            return F.when(in_batch, F.col(f"b.last.{name}")).otherwise(F.col(f"t.{name}"))
        if name in kept:
            return F.when(old, F.col(f"t.{name}")).otherwise(F.col(f"b.first.{name}"))
        return F.col(f"t.{name}")

    merged = joined.select([value(c).alias(c) for c in target_columns]).unionByName(target.filter(~has_key))
    unkeyed = batch.filter(~has_key)
    return merged.unionByName(
        unkeyed.select([c for c in target_columns if c in unkeyed.columns]), allowMissingColumns=True
    )


def _days(column: str, values: Iterable) -> Callable[[dict[str, str]], bool]:
    """Partitions of these days; a missing day has its own."""
    names = {NULL_VALUE if v is None else str(v) for v in values}
    return lambda spec: spec[column] in names


def upsert_predictions_table(lake: Lake, batch: DataFrame, order_by: Sequence[Column | str]) -> None:
    """Merge scored flights into the predictions table, rewriting only the batch's flight dates.

    The batch is computed once: its days, its keyed and its other rows all come from one copy.
    """
    lake.create("ml", "flight_predictions")
    batch = written(batch, "upsert_batch")
    # One value per calendar day of the batch, as literals for partition pruning.
    days = [row[0] for row in batch.select("flight_date").distinct().collect()]
    base = lake.version("ml", "flight_predictions")
    target = lake.table("ml", "flight_predictions", base, _days("flight_date", days))
    lake.replace_partitions("ml", "flight_predictions", merge_predictions(target, batch, order_by), base)


def update_minutes_table(
    lake: Lake,
    scores: DataFrame,
    flight_date: dt.date,
    model_name: str,
    model_version: str,
    order_by: Sequence[Column | str],
) -> int:
    """Write predicted minutes onto the flights of one day predicted late; returns rows updated."""
    base = lake.version("ml", "flight_predictions")
    target = lake.table("ml", "flight_predictions", base, _days("flight_date", [flight_date]))
    observation = Observation("update minutes")
    updated = apply_minutes(target, scores, model_name, model_version, order_by, flag="updated")
    count = F.count_if("updated").alias("rows")
    lake.replace_partitions("ml", "flight_predictions", updated.observe(observation, count).drop("updated"), base)
    return observed(observation, updated, [count])["rows"]


def reconcile_table(
    lake: Lake,
    predictions: DataFrame,
    table: str = "raw_flights",
    date_photos: Iterable[dt.date] | None = None,
    flight_dates: Iterable[dt.date] | None = None,
) -> int:
    """Fill ``is_delayed_predicted`` in the analytics table; returns rows matched.

    A narrow pass over key columns finds the snapshot dates with a label to change; only those are
    rewritten. ``date_photos`` limits it to those snapshots, ``flight_dates`` to flights and predictions of
    those days: the prediction table is pruned to them, and the analytics table to snapshots that are not
    older than the first.
    """
    base = lake.version("analytics", table)
    target = lake.table("analytics", table, base)
    if date_photos is not None:
        target = target.filter(F.col("date_photo").isin(list(date_photos)))
    if flight_dates is not None:
        days = sorted(flight_dates)
        if not days:
            return 0
        first = F.lit(days[0].isoformat()).cast("date")
        target = target.filter(F.col("date").isin(days) & (F.col("date_photo") >= first))
        predictions = predictions.filter(F.col("flight_date").isin(days))
    old = F.col("is_delayed_predicted")
    narrow = target.select(
        "flight_number", "date", "origin_airport", "date_photo", "is_delayed_predicted", old.alias("old")
    )
    # One row per snapshot date.
    found = (
        reconcile(narrow, predictions, flag="matched")
        .groupBy("date_photo")
        .agg(F.count_if("matched").alias("matched"), F.count_if(~old.eqNullSafe(F.col("old"))).alias("changed"))
        .collect()
    )
    changed = [r["date_photo"] for r in found if r["changed"]]
    if changed:
        stored = lake.table("analytics", table, base, _days("date_photo", changed))
        lake.replace_partitions("analytics", table, reconcile(stored, predictions), base)
    return sum(r["matched"] for r in found)
