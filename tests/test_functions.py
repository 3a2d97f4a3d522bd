"""Column functions on literal frames: the parity notes, one by one."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from delaylake import functions as fn


def values(spark, inputs, ddl, expression):
    """Results in input order; the index keeps it."""
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v")).alias("x")).collect()]


def test_calendar_of_a_sunday_and_null(spark):
    days = [dt.date(2026, 3, 8), dt.date(2026, 3, 9), None]
    assert values(spark, days, "date", fn.day_of_week) == [7, 1, None]
    assert values(spark, days, "date", fn.day_name) == ["Sunday", "Monday", None]
    assert values(spark, days, "date", fn.month_number) == [3, 3, None]
    assert values(spark, days, "date", fn.month_name) == ["March", "March", None]


@pytest.mark.parametrize(
    "text,hour",
    [("2026-07-08T22:30:00Z", 0), ("2026-01-08T22:30:00Z", 23), ("2026-03-29T01:30:00Z", 3), ("2026-10-25T00:30:00Z", 2)],
)
def test_local_hour_follows_daylight_saving(spark, text, hour):
    df = spark.createDataFrame([(text,)], "t string").withColumn("t", F.col("t").cast("timestamp"))
    assert df.select(fn.local_hour(df, "t")).first()[0] == hour


def test_local_hour_of_a_time_without_zone_is_its_own(spark):
    df = spark.createDataFrame([("2026-07-08 22:30:00",)], "t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert df.select(fn.local_hour(df, "t")).first()[0] == 22


def test_time_blocks(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23, None]
    assert values(spark, hours, "int", fn.time_block) == [
        "night", "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", None,
    ]


def test_delay_minutes_and_flags(spark):
    start = dt.datetime(2026, 3, 8, 12, 0)
    rows = [
        (i, start + dt.timedelta(minutes=m) if m is not None else None, start, s)
        for i, (m, s) in enumerate(
            [(-5.0, "X"), (0.0, None), (0.5, "X"), (15.0, "X"), (15.1, "X"), (60.0, "X"), (60.1, "X"), (None, "X"),
             (90.0, "CANCELLED"), (30.0, "ARRIVED")]
        )
    ]
    df = spark.createDataFrame(rows, "i int, a timestamp_ntz, s timestamp_ntz, status string")
    df = df.withColumn("m", fn.delay_minutes(F.col("a"), F.col("s"), F.col("status")))
    out = df.orderBy("i").select(
        "m", fn.delay_category(F.col("m")), fn.is_delayed(F.col("m")), fn.is_major_delay(F.col("m")),
        fn.is_cancelled(F.col("status")), fn.is_landed(F.col("status")),
    ).collect()
    assert [r[0] for r in out] == [-5.0, 0.0, 0.5, 15.0, 15.1, 60.0, 60.1, None, None, 30.0]
    assert [r[1] for r in out] == [
        "on_time", "on_time", "minor_delay", "minor_delay", "major_delay", "major_delay", "major_delay", None, None,
        "major_delay",
    ]
    assert [r[2] for r in out] == [False, False, False, False, True, True, True, False, False, True]
    assert [r[3] for r in out] == [False, False, False, False, False, False, True, False, False, False]
    assert [r[4] for r in out] == [False] * 8 + [True, False]
    assert [r[5] for r in out] == [False] * 9 + [True]


def test_delay_minutes_match_python_durations(spark):
    start = dt.datetime(2026, 3, 8, 12, 0)
    ends = [start + dt.timedelta(microseconds=m) for m in (1, 179575, 60_000_001, 987_654_321, -33_333_333)]
    df = spark.createDataFrame([(e, start) for e in ends], "a timestamp_ntz, s timestamp_ntz")
    got = [r[0] for r in df.select(fn.delay_minutes(F.col("a"), F.col("s"), F.lit("X"))).collect()]
    assert got == [(e - start).total_seconds() / 60 for e in ends]


def test_braces_to_value(spark):
    texts = ["{55}", "{}", "{55,93}", "{x}", "{055}", None, "{93.5}"]
    assert values(spark, texts, "string", fn.braces_to_value) == [55, None, None, None, 55, None, None]
    assert values(spark, texts, "string", lambda c: fn.braces_to_value(c, "str"))[:4] == ["55", None, "55,93", "x"]
    assert values(spark, texts, "string", lambda c: fn.braces_to_value(c, "first"))[:3] == ["55", None, "55"]
    assert values(spark, texts, "string", lambda c: fn.braces_to_value(c, "array"))[:3] == [["55"], None, ["55", "93"]]
    with pytest.raises(ValueError):
        fn.braces_to_value(F.col("v"), "float")


def test_delay_code_forms(spark):
    forms = [None, "93", '["55","93"]', "7", "[]", "[odd"]
    assert values(spark, forms, "string", fn.delay_code_to_braces) == ["{}", "{93}", "{55,93}", "{7}", "{}", "{[odd}"]


def test_timestamps_and_dates(spark):
    texts = ["2026-03-07T06:00:00+01:00", "2026-03-07T08:30:00.123Z", "2026-03-07 08:30:00", "not_a_date", None]
    utc = values(spark, texts, "string", lambda c: fn.to_utc_timestamp(c).cast("timestamp_ntz"))
    assert utc == [
        dt.datetime(2026, 3, 7, 5, 0), dt.datetime(2026, 3, 7, 8, 30, 0, 123000), dt.datetime(2026, 3, 7, 8, 30), None,
        None,
    ]
    assert values(spark, texts, "string", fn.to_calendar_date) == [dt.date(2026, 3, 7)] * 3 + [None, None]


def test_integers(spark):
    texts = ["12", " 12 ", "1e3", "93.5", "93.0", "null", "junk", "1d", None, "9007199254740993", "-7"]
    assert values(spark, texts, "string", fn.to_integer) == [
        12, 12, 1000, None, 93, None, None, None, None, 9007199254740993, -7,
    ]


def test_text_and_boolean_maps(spark):
    assert values(spark, ["a", None], "string", lambda c: fn.to_text(c, "None")) == ["a", "None"]
    assert values(spark, ["a", None], "string", fn.to_text) == ["a", None]
    assert values(spark, ["Y", "N", "?", None], "string", lambda c: fn.bool_map(c, {"Y": True, "N": False})) == [
        True, False, None, None,
    ]
    assert values(spark, ["XGB", "Other"], "string", lambda c: fn.map_value(c, {"XGB": "XGBoost"})) == [
        "XGBoost", "Other",
    ]


def test_clip_and_round_is_half_even(spark):
    assert values(spark, [-1.0, 2.25, 2.35, None], "double", fn.clip_and_round)[:2] == [0.0, 2.2]


def test_elapsed_seconds(spark):
    df = spark.createDataFrame([("2026-03-07T06:00:00Z", "2026-03-07T06:01:30.5Z"), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(fn.elapsed_seconds(F.col("a"), F.col("b"))).collect()] == [90.5, None]
