"""Streaming forms of ingest, dedupe and readiness."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from ..constants import EXPECTED_AIRPORTS, READINESS_HOURS
from ..operators.joins import checked_broadcast
from ..operators.quality import observed
from ..sinks.lake import Lake
from ..sinks.snapshots import replace_snapshots
from ..sinks.versions import VersionedTable


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    file_format: str = "json",
    max_files: int | None = None,
    **options,
) -> DataFrame:
    """Files as they land; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def run_available(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
) -> StreamingQuery:
    """Process everything that has landed, then stop; the checkpoint makes the next run continue."""
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that Spark itself has left out because they were older than the watermark, in the batches it still reports."""
    return sum(state["numRowsDroppedByWatermark"] for p in query.recentProgress for state in p["stateOperators"])


def batch_folder(path: str, batch_id: int) -> str:
    """Where a micro-batch writes; a replayed one overwrites its own rows and adds none."""
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def snapshot_stream(
    lake: Lake,
    stream: DataFrame,
    layer: str,
    table: str,
    checkpoint: str,
    mode: str = "raw",
    airport_column: str = "origin_airport",
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    poll: Column | None = None,
) -> StreamingQuery:
    """Snapshots from files that land, whole however their files fall into micro-batches.

    Micro-batches only land their rows: each commits a folder of its own, which a replay replaces, and notes in an index which
    dates, airports and polls it holds. When everything available has landed, the snapshots touched are published in one
    write: of each date and airport all rows of its newest poll. ``poll``, over the prepared rows, tells rows of one
    delivery from those of another, the larger text being the newer, and then a delivery may also be spread over several
    runs. Without it a run is a poll: files of one delivery have to land before the run starts.

    The index decides which folders a publish opens, so its cost follows what is new and not what ever landed; folders that
    hold nothing but superseded polls leave with it. A run that ends between landing and publishing leaves its rows to
    the next one.
    """
    landed = VersionedTable(lake.spark, f"{checkpoint.rstrip('/')}-landed")

    def land(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch).withColumn("date_photo", F.col("date_photo").cast("date"))
        rows = rows.withColumns({_POLL: (F.lit(None) if poll is None else poll).cast("string"), _BATCH: F.lit(batch_id).cast("bigint")})
        landed.create(rows.schema, (_BATCH,))
        # One entry per date, airport and poll of the batch.
        entry = F.collect_set(F.struct(F.col("date_photo").cast("string"), F.col(airport_column).cast("string"), _POLL))
        observation = Observation("landed")
        written = landed.write(rows.observe(observation, entry.alias("entries")), rebalance=False)
        entries = [list(e) for e in observed(observation, rows, [entry.alias("entries")])["entries"]] if written else []
        landed.commit(
            written,
            drop=lambda spec: not written and spec[_BATCH] == str(batch_id),
            notes=lambda notes: _noted(notes, {**_index(notes), batch_id: entries}),
        )

    query = run_available(stream, land, checkpoint)
    _publish_landed(lake, landed, layer, table, mode, airport_column)
    return query


_POLL, _BATCH = "poll_id", "batch_id"


def _index(notes: dict[str, str]) -> dict[int, list[list[str | None]]]:
    """Date, airport and poll of what every landed batch still holds; it grows with these, not with rows."""
    return {int(batch): entries for batch, entries in json.loads(notes.get("index", "{}")).items()}


def _noted(notes: dict[str, str], index: dict, published: int | None = None) -> dict[str, str]:
    changed = {"index": json.dumps({batch: entries for batch, entries in index.items() if entries})}
    return {**notes, **changed, **({} if published is None else {"published": str(published)})}


def _publish_landed(lake: Lake, landed: VersionedTable, layer: str, table: str, mode: str, airport_column: str) -> None:
    if not landed.exists():
        return
    version = landed.current()
    index, done = _index(version.notes), int(version.notes.get("published", -1))
    touched = {(day, airport) for batch, entries in index.items() if batch > done for day, airport, _ in entries}
    if not touched:
        return
    upto = max(index)
    # Without polls, what has been published before is a poll of its own that new rows replace.
    live = [
        (batch, day, airport, poll)
        for batch, entries in index.items()
        for day, airport, poll in entries
        if (day, airport) in touched and (poll is not None or batch > done)
    ]
    newest: dict = {}
    for _, day, airport, poll in live:
        newest[(day, airport)] = max(newest.get((day, airport), ""), poll or "")
    batches = {batch for batch, day, airport, poll in live if newest[(day, airport)] == (poll or "")}
    rows = landed.read(version.number, lambda spec: int(spec[_BATCH]) in batches)
    wanted = [(day, airport, poll or None) for (day, airport), poll in newest.items()]
    # One row per date and airport touched.
    wanted = checked_broadcast(lake.spark.createDataFrame(wanted, "n_date string, n_airport string, n_poll string"))
    whole = rows.filter(F.col(_POLL).isNotNull() | (F.col(_BATCH) > done)).join(
        wanted,
        F.col("date_photo").eqNullSafe(F.col("n_date").cast("date"))
        & F.col(airport_column).cast("string").eqNullSafe(F.col("n_airport"))
        & F.col(_POLL).eqNullSafe(F.col("n_poll")),
        "left_semi",
    )
    replace_snapshots(lake, whole.drop(_BATCH, _POLL), layer, table, mode, airport_column)

    def trimmed(notes: dict[str, str]) -> dict[int, list]:
        """What a later publish can still need: the newest poll of each snapshot, and what has landed meanwhile."""
        return {
            batch: [
                [day, airport, poll]
                for day, airport, poll in entries
                if batch > upto or (poll is not None and newest.get((day, airport), poll) <= poll)
            ]
            for batch, entries in _index(notes).items()
        }

    kept = {batch for batch, entries in trimmed(version.notes).items() if entries}
    landed.commit(
        drop=lambda spec: int(spec[_BATCH]) <= upto and int(spec[_BATCH]) not in kept,
        notes=lambda notes: _noted(notes, trimmed(notes), upto),
    )


def dedupe_stream(stream: DataFrame, keys: Sequence[str], event_time: str, late_by: str) -> DataFrame:
    """First row per key among rows at most ``late_by`` apart; older keys leave the state."""
    return (
        stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
        .withWatermark(event_time, late_by)
        .dropDuplicatesWithinWatermark(list(keys))
    )


def coverage_stream(
    stream: DataFrame,
    event_time: str,
    airport_column: str,
    late_by: str,
    expected: Sequence[str] = EXPECTED_AIRPORTS,
    hours: int = READINESS_HOURS,
) -> DataFrame:
    """Missing airports per tumbling window.

    The state of a window is one flag per expected airport, however many rows arrive.
    """
    flags = [F.max(F.col(airport_column).eqNullSafe(F.lit(a))).alias(f"seen_{a}") for a in expected]
    missing = F.array_compact(F.array(*[F.when(~F.col(f"seen_{a}"), F.lit(a)) for a in expected]))
    return (
        stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
        .withWatermark(event_time, late_by)
        .groupBy(F.window(event_time, f"{hours} hours"))
        .agg(*flags)
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            missing.alias("missing"),
            (F.size(missing) == 0).alias("ready"),
        )
    )


_NEWEST_ORDER, _NEWEST_TIE, _NEWEST_ROW = "event_ms", "tie", "row"
_NEWEST_COLUMNS = [_NEWEST_ORDER, _NEWEST_TIE, _NEWEST_ROW]
_HELD = f"{_NEWEST_ORDER} bigint, {_NEWEST_TIE} bigint, {_NEWEST_ROW} string"
#: Rows travel through the state as text, complete and with microseconds.
_ROW_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _newest_per_key(quiet_ms: int):
    """Holds the newest row of a key; emits it when the watermark, or a later row, is ``quiet_ms`` past it."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = tuple(state.get) if state.exists else None
        watermark, out = state.getCurrentWatermarkMs(), []

        def close() -> None:
            nonlocal held
            if held is not None:
                out.append((*held, False))
                held = None

        if state.hasTimedOut:
            close()
        else:
            if held is not None and held[0] + quiet_ms <= watermark:
                close()
            # Runs once per key and micro-batch, mostly on a few rows: building frames would cost more than going through them.
            for row in sorted(row for frame in frames for row in zip(*(frame[c].tolist() for c in _NEWEST_COLUMNS))):
                if row[0] <= watermark:
                    out.append((*row, True))
                elif held is None or row[0] >= held[0] + quiet_ms:
                    close()
                    held = row
                else:
                    held = max(held, row)
        if held is None:
            state.remove()
        else:
            state.update(held)
            # Fires once the watermark is beyond this instant, which is before the row becomes quiet by a millisecond.
            state.setTimeoutTimestamp(held[0] + quiet_ms - 1)
        if out:
            yield pd.DataFrame(np.array(out, dtype=object), columns=[*_NEWEST_COLUMNS, "late"])

    return run


def newest_stream(
    stream: DataFrame, keys: Sequence[str], event_time: str, late_by: str, quiet: dt.timedelta, tie_break: Column | None = None
) -> DataFrame:
    """The newest row of every key, once nothing of it has come for ``quiet``; the stream's columns and ``late``.

    State holds one row per key, the one of the largest event time (of equal ones the larger ``tie_break``, a bigint). It is
    emitted and leaves the state when the watermark, ``late_by`` behind the newest event, reaches its event time plus ``quiet``,
    or when a row of the key comes that is so much newer; that row is held next. Rows not newer than the watermark change nothing and
    come out at once with ``late`` set, so a sink can count and keep them; those older than the watermark before that one
    Spark leaves out by itself, and counts (``dropped_rows``). A row without event time has no place in time: it comes out late as well. Times count in
    milliseconds, as watermarks do. Keys may be NULL.
    """
    schema = stream.schema
    at = F.col(event_time).cast("timestamp")
    tie = F.xxhash64(*stream.columns) if tie_break is None else tie_break.cast("bigint")
    named = {f"key_{i}": F.col(k) for i, k in enumerate(keys)}
    packed = stream.select(
        *[c.alias(name) for name, c in named.items()],
        F.coalesce(at, F.timestamp_millis(F.lit(0))).alias("event_at"),
        F.coalesce(F.unix_millis(at), F.lit(-1)).alias(_NEWEST_ORDER),
        F.coalesce(tie, F.lit(0)).alias(_NEWEST_TIE),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in stream.columns]), _ROW_OPTIONS).alias(_NEWEST_ROW),
    ).withWatermark("event_at", late_by)
    quiet_ms = quiet // dt.timedelta(milliseconds=1)
    if quiet_ms < 1:
        raise ValueError("quiet has to be a millisecond at least")
    found = packed.groupBy(*named).applyInPandasWithState(
        _newest_per_key(quiet_ms), f"{_HELD}, late boolean", _HELD, "append", GroupStateTimeout.EventTimeTimeout
    )
    return found.select(F.from_json(_NEWEST_ROW, schema, _ROW_OPTIONS).alias("r"), "late").select("r.*", "late")
