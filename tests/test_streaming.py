"""Streams over files that land between runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

import pandas as pd
import pytest

from delaylake.sinks.versions import VersionedTable
from delaylake.streaming import (
    batch_folder,
    coverage_stream,
    dedupe_stream,
    dropped_rows,
    file_stream,
    newest_stream,
    run_available,
    snapshot_stream,
    streams,
)

DDL = "flight_id string, date_photo date, origin_airport string"
D = dt.date(2026, 3, 7)
NEXT = D + dt.timedelta(days=1)


def land(spark, path, rows, ddl):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").json(str(path))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_snapshots_follow_the_files(spark, lake, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    lake.create("raw", "t", DDL, ("date_photo", "origin_airport"))

    def run(mode):
        snapshot_stream(lake, file_stream(spark, str(landing), DDL), "raw", "t", checkpoint, mode)
        return rows_of(lake.table("raw", "t").select("flight_id"))

    land(spark, landing, [("a", D, "NCE"), ("b", D, "LYS"), ("c", NEXT, "NCE")], DDL)
    assert run("raw") == [("a",), ("b",), ("c",)]
    assert run("raw") == [("a",), ("b",), ("c",)]  # nothing new
    land(spark, landing, [("a2", D, "NCE")], DDL)
    assert run("raw") == [("a2",), ("b",), ("c",)]
    land(spark, landing, [("d", NEXT, "LYS")], DDL)
    assert run("scheduled") == [("a2",), ("c",), ("d",)]
    assert lake.watermark("raw", "t") == NEXT


def test_a_snapshot_over_many_batches_stays_whole(spark, lake, tmp_path):
    ddl = DDL + ", load string"
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    lake.create("raw", "t", DDL, ("date_photo", "origin_airport"))

    def run(poll):
        stream = file_stream(spark, str(landing), ddl, max_files=1)
        snapshot_stream(lake, stream, "raw", "t", checkpoint, poll=poll)
        return rows_of(lake.table("raw", "t").select("flight_id"))

    for part in range(4):
        land(spark, landing, [(f"p1-{part}-{i}", D, "NCE", "1") for i in range(5)], ddl)
    land(spark, landing, [("other", D, "LYS", "1")], ddl)
    first = [("other",)] + [(f"p1-{p}-{i}",) for p in range(4) for i in range(5)]
    assert run(F.col("load")) == first
    # A second delivery, spread over two runs, replaces the first; a late file of the first changes nothing.
    land(spark, landing, [("p2-a", D, "NCE", "2")], ddl)
    land(spark, landing, [("late", D, "NCE", "1")], ddl)
    assert run(F.col("load")) == [("other",), ("p2-a",)]
    land(spark, landing, [("p2-b", D, "NCE", "2")], ddl)
    assert run(F.col("load")) == [("other",), ("p2-a",), ("p2-b",)]


def test_a_replayed_batch_adds_nothing(spark, lake, tmp_path):
    import shutil

    landing, checkpoint = tmp_path / "landing", tmp_path / "checkpoint"
    lake.create("raw", "t", DDL, ("date_photo", "origin_airport"))
    land(spark, landing, [("a", D, "NCE"), ("b", D, "NCE")], DDL)

    def run():
        snapshot_stream(lake, file_stream(spark, str(landing), DDL), "raw", "t", str(checkpoint))
        return rows_of(lake.table("raw", "t").select("flight_id"))

    assert run() == [("a",), ("b",)]
    shutil.rmtree(checkpoint / "commits")  # as after a crash between a batch's write and its commit
    assert run() == [("a",), ("b",)]


def test_a_run_that_ends_before_it_publishes_leaves_its_rows_to_the_next(spark, lake, tmp_path, monkeypatch):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    lake.create("raw", "t", DDL, ("date_photo", "origin_airport"))

    def run():
        snapshot_stream(lake, file_stream(spark, str(landing), DDL), "raw", "t", checkpoint)
        return rows_of(lake.table("raw", "t").select("flight_id"))

    land(spark, landing, [("a", D, "NCE")], DDL)
    with monkeypatch.context() as broken:
        broken.setattr(streams, "replace_snapshots", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            run()
    land(spark, landing, [("b", D, "LYS")], DDL)
    assert run() == [("a",), ("b",)]
    with monkeypatch.context() as broken:  # published, but not noted: the next run publishes the same again
        broken.setattr(streams, "_noted", lambda notes, index, published=None: 1 / 0 if published is not None else original(notes, index))
        land(spark, landing, [("c", NEXT, "NCE")], DDL)
        original = ORIGINAL_NOTED
        with pytest.raises(ZeroDivisionError):
            run()
    assert run() == [("a",), ("b",), ("c",)]


ORIGINAL_NOTED = streams._noted


def test_a_publish_opens_only_folders_of_touched_snapshots(spark, lake, tmp_path, monkeypatch):
    ddl = DDL + ", load string"
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    lake.create("raw", "t", DDL, ("date_photo", "origin_airport"))
    opened = []
    original = VersionedTable._rows
    monkeypatch.setattr(
        VersionedTable, "_rows", lambda self, version, parts: opened.append((self.path, len(parts))) or original(self, version, parts)
    )

    def run(*polls):
        for airport, day, load in polls:
            land(spark, landing, [(f"{airport}{load}{i}", day, airport, load) for i in range(3)], ddl)
        opened.clear()
        stream = file_stream(spark, str(landing), ddl, max_files=1)
        snapshot_stream(lake, stream, "raw", "t", checkpoint, poll=F.col("load"))
        return [n for path, n in opened if path.endswith("-landed")]

    landed = VersionedTable(spark, f"{checkpoint}-landed")
    assert run(("NCE", D, "1"), ("LYS", D, "1"), ("NCE", NEXT, "1"), ("LYS", NEXT, "1")) == [4]
    # One snapshot of four is polled again: one folder is read, and that of the superseded poll goes.
    assert run(("LYS", NEXT, "2")) == [1]
    assert len(landed.current().parts) == 4
    # A part of the same poll joins the folder that holds the rest of it.
    assert run(("LYS", NEXT, "2")) == [2]
    assert run() == []
    expected = {f"{a}{load}{i}": n for a, load, n in (("NCE", "1", 2), ("LYS", "1", 1), ("LYS", "2", 2)) for i in range(3)}
    counted = lake.table("raw", "t").groupBy("flight_id").count().collect()
    assert {r[0]: r[1] for r in counted} == expected


def test_newest_row_per_key_leaves_the_state_when_it_is_quiet(spark, tmp_path):
    ddl = "k string, v int, ts timestamp"
    start = dt.datetime(2026, 3, 7)
    at = lambda hours, micros=0: start + dt.timedelta(hours=hours, microseconds=micros)
    landing, out = tmp_path / "landing", str(tmp_path / "out")

    def run(*rows):
        if rows:
            spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(landing))
        stream = newest_stream(file_stream(spark, str(landing), ddl, "parquet"), ["k"], "ts", "3 hours", dt.timedelta(hours=2), F.col("v"))
        write = lambda b, i: b.write.mode("overwrite").parquet(batch_folder(out, i))
        query = run_available(stream, write, str(tmp_path / "checkpoint"))
        progress = query.recentProgress[-1]["stateOperators"] if query.recentProgress else [{"numRowsTotal": None}]
        rows = spark.read.schema(f"{ddl}, late boolean, batch_id int").parquet(out)
        found = rows_of(rows.select("k", "v", "late", F.col("ts").cast("string")))
        return found, progress[0]["numRowsTotal"], dropped_rows(query)

    # Nothing is quiet yet; of equal times the larger tie break is held.
    found, held, _ = run(("a", 1, at(0, 123456)), ("a", 2, at(0, 123456)), ("b", 3, at(0.5)), (None, 4, at(1)), ("a", 0, at(-0.5)))
    assert (found, held) == ([], 3)
    # A newer row takes the place of an older one, whatever the order of arrival.
    found, held, _ = run(("b", 5, at(1)), ("b", 6, at(0.8)))
    assert (found, held) == ([], 3)
    # The watermark passes them all at 6 - 3 = 3 hours; they are emitted with microseconds and leave.
    quiet = [("a", 2, False, "2026-03-07 00:00:00.123456"), ("b", 5, False, "2026-03-07 01:00:00"), (None, 4, False, "2026-03-07 01:00:00")]
    found, held, _ = run(("c", 7, at(6)))
    assert (found, held) == (sorted(quiet, key=repr), 1)
    # Too late: not newer than the watermark. On time: a new row of a key that has left, and one a pause after a held one.
    found, held, dropped = run(("a", 8, at(3)), ("a", 9, at(3.1)), ("c", 10, at(8)), ("d", 11, None))
    came = [("c", 7, False, "2026-03-07 06:00:00")]
    late = [r for r in found if r[2]]
    assert sorted((r for r in found if not r[2]), key=repr) == sorted(quiet + came, key=repr)
    assert (len(late) + dropped, held) == (2, 2)
    # Many keys come and go: the state falls again.
    _, held, _ = run(*[(f"k{i}", i, at(9)) for i in range(50)])
    assert held >= 50
    found, held, _ = run(("z", 0, at(48)))
    assert held == 1 and len([r for r in found if r[0] and r[0].startswith("k")]) == 50
    with pytest.raises(ValueError):
        newest_stream(spark.createDataFrame([], ddl), ["k"], "ts", "3 hours", dt.timedelta(0))


class HeldState:
    """The part of Spark's group state that a function of one key uses."""

    def __init__(self, held=None, watermark=0, timed_out=False):
        self.get, self.watermark, self.hasTimedOut, self.timeout = held, watermark, timed_out, None

    exists = property(lambda self: self.get is not None)

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, held):
        self.get = held

    def remove(self):
        self.get = None

    def setTimeoutTimestamp(self, at):
        self.timeout = at


def columns(*rows):
    """A chunk of rows that only gives single columns, as a frame does, but makes no other frame."""
    return {c: pd.Series([r[i] for r in rows], dtype="object" if c == "row" else "int64") for i, c in enumerate(("event_ms", "tie", "row"))}


@pytest.mark.parametrize(
    ("state", "chunks", "out", "held"),
    [
        # Two chunks out of order, a row twice, equal times: the larger tie break, then the larger row is held.
        (HeldState(), [[(50, 1, "b"), (10, 1, "a")], [(50, 2, "c"), (50, 2, "c"), (50, 2, "d")]], [], (50, 2, "d")),
        # A pause in one chunk; an older row than the one held changes nothing, not even one a pause before it.
        (HeldState((500, 1, "h"), 5), [[(700, 1, "y"), (20, 9, "x")]], [(500, 1, "h", False)], (700, 1, "y")),
        # The held row has become quiet. Rows not newer than the watermark, also one without a time, come out late.
        (HeldState((50, 1, "h"), 150), [[(150, 1, "l"), (151, 0, "n"), (-1, 0, "no time")]], [(50, 1, "h", False), (-1, 0, "no time", True), (150, 1, "l", True)], (151, 0, "n")),
        # Only late rows of a key that holds nothing; an empty chunk; a key timed out.
        (HeldState(None, 150), [[(3, 1, "l")]], [(3, 1, "l", True)], None),
        (HeldState((500, 1, "h"), 5), [[]], [], (500, 1, "h")),
        (HeldState((50, 1, "h"), 150, timed_out=True), [[]], [(50, 1, "h", False)], None),
    ],
)
def test_newest_row_is_found_without_frames_of_a_key(monkeypatch, state, chunks, out, held):
    made = []
    monkeypatch.setattr(streams.pd, "DataFrame", lambda *a, f=pd.DataFrame, **b: made.append(f(*a, **b)) or made[-1])
    found = list(streams._newest_per_key(100)(("k",), (columns(*rows) for rows in chunks), state))
    assert [tuple(row) for frame in found for row in frame.values.tolist()] == out
    assert state.get == held and state.timeout == (None if held is None else held[0] + 99)
    assert len(made) == len(found) == (1 if out else 0)  # one frame for all rows that leave, none else


def test_dedupe_keeps_one_row_per_key_across_runs(spark, tmp_path):
    ddl = "k string, v int, ts timestamp"
    t = dt.datetime(2026, 3, 7, 6)
    landing, out = tmp_path / "landing", str(tmp_path / "out")

    def run():
        stream = dedupe_stream(file_stream(spark, str(landing), ddl), ["k"], "ts", "1 hour").select("k")
        write = lambda b, i: b.write.mode("overwrite").parquet(batch_folder(out, i))
        run_available(stream, write, str(tmp_path / "checkpoint"))
        return rows_of(spark.read.schema("k string, batch_id int").parquet(out).drop("batch_id"))

    land(spark, landing, [("a", 1, t), ("a", 2, t), ("b", 1, t)], ddl)
    assert run() == [("a",), ("b",)]
    land(spark, landing, [("a", 3, t + dt.timedelta(minutes=20)), ("c", 1, t)], ddl)
    assert run() == [("a",), ("b",), ("c",)]


def test_coverage_per_window(spark, tmp_path):
    ddl = "origin_airport string, ts timestamp"
    t = dt.datetime(2026, 3, 7, 6)
    rows = [(a, t + dt.timedelta(minutes=m)) for m, a in enumerate(["NCE", "LYS", "MRS", "TLS", "BOD"])]
    rows += [("NCE", t + dt.timedelta(hours=2)), ("ORY", t + dt.timedelta(hours=2)), (None, t + dt.timedelta(hours=3))]
    land(spark, tmp_path / "landing", rows, ddl)
    out = str(tmp_path / "out")
    stream = coverage_stream(file_stream(spark, str(tmp_path / "landing"), ddl), "ts", "origin_airport", "1 hour")
    run_available(
        stream.select(F.col("window_start").cast("string"), "missing", "ready"),
        lambda b, _: b.write.mode("overwrite").parquet(out), str(tmp_path / "checkpoint"), "complete",
    )
    got = rows_of(spark.read.schema("window_start string, missing array<string>, ready boolean").parquet(out))
    assert got == [
        ("2026-03-07 06:00:00", [], True),
        ("2026-03-07 08:00:00", ["LYS", "MRS", "TLS", "BOD"], False),
    ]
