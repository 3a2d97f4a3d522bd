"""Plans and hot keys: what has to hold when the tables are large."""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from delaylake.operators import drop_duplicates, equi_join, latest_version, semi_join
from delaylake.sinks.snapshots import replace_snapshots
from delaylake.sources import in_reference_day, on_route

ROWS = 30_000


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def small_partitions(spark):
    """Thresholds scaled down so that a third of these rows counts as a hot partition."""
    with settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
            "spark.sql.shuffle.partitions": "8",
        },
    ):
        yield


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_rows(spark):
    """A third of the rows has key 0."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    return spark.range(0, ROWS, 1, 8).select(key.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def dimension(spark):
    return spark.range(0, ROWS // 2, 1, 4).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))


@pytest.mark.parametrize("how,hot_side", [("left", None), ("inner", None), ("right", "left"), ("outer", None)])
def test_a_hot_join_key_is_split(spark, small_partitions, how, hot_side):
    facts, names = hot_rows(spark), dimension(spark)
    joined = equi_join(facts, names, {"k": "k"}, how, hot_side=hot_side)
    rows = joined.agg(F.count("*"), F.count("v"), F.count("w"), F.sum("w")).first()
    keys = [0 if i % 3 == 0 else i for i in range(ROWS)]
    matched = [k for k in keys if k < ROWS // 2]
    alone = ROWS // 2 - len(set(matched))
    left_rows = ROWS if how in ("left", "outer") else len(matched)
    right_rows = alone if how in ("right", "outer") else 0
    missing = {i for i in range(ROWS // 2)} - set(matched)
    extra = sum(2 * k for k in missing) if right_rows else 0
    assert tuple(rows) == (
        left_rows + right_rows, left_rows, len(matched) + right_rows, sum(2 * k for k in matched) + extra,
    )
    executed = joined.groupBy("k").agg(F.count("*").alias("n"))
    executed.collect()
    assert "skew=true" in plan_of(executed)


def test_hot_keys_on_the_optional_side_of_a_left_join(spark, small_partitions):
    joined = equi_join(dimension(spark), hot_rows(spark), {"k": "k"}, "left", hot_side="right")
    counted = joined.groupBy("k").agg(F.count("v").alias("n"))
    by_key = {r.k: r.n for r in counted.collect()}
    assert "skew=true" in plan_of(counted)
    assert len(by_key) == ROWS // 2 and by_key[0] == ROWS // 3 and by_key[3] == 0 and by_key[4] == 1


def test_semi_join_reduces_its_keys_first(spark):
    plan = plan_of(semi_join(dimension(spark), hot_rows(spark), {"k": "k"}))
    assert "LeftSemi" in plan and "HashAggregate(keys=[key_0" in plan


def test_hot_groups_shrink_before_the_shuffle(spark):
    hot = hot_rows(spark)
    for df in (
        drop_duplicates(hot, ["k"], ["v"]),
        drop_duplicates(hot, ["k"], ["v"], "first"),
        latest_version(hot, ["k"], "v", ["pad"]),
    ):
        plan = plan_of(df)
        assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    single = drop_duplicates(hot, ["k"], [], False)
    plan = plan_of(single)
    # Two rows of a key tell that it is repeated; more of them never leave their task.
    assert plan.index("Final") < plan.index("Exchange") < plan.index(", 2, Partial")
    assert single.count() == ROWS - ROWS // 3


def test_filters_reach_the_scan(spark, tmp_path):
    ddl = "origin_airport string, destination_airport string, airline_code string, t timestamp, wide string"
    spark.createDataFrame([], ddl).write.parquet(str(tmp_path / "f"))
    df = on_route(spark.read.schema(ddl).parquet(str(tmp_path / "f")))
    with settings(spark, **{"spark.sql.maxMetadataStringLength": "2000"}):
        plan = plan_of(in_reference_day(df, "t", dt.date(2026, 3, 8), "raw").select("origin_airport"))
    assert "In(origin_airport" in plan and "EqualTo(destination_airport,CDG)" in plan
    assert "GreaterThanOrEqual(t,2026-03-07" in plan and "LessThan(t,2026-03-08" in plan
    assert "wide" not in plan


def test_a_hot_partition_is_written_by_several_tasks(spark, lake):
    ddl = "v bigint, pad string, date_photo date, origin_airport string"
    lake.create("raw", "hot", ddl, ("date_photo", "origin_airport"))
    rows = hot_rows(spark).select(
        "v", "pad", F.lit("2026-03-07").cast("date").alias("date_photo"),
        F.when(F.col("k") == 0, "NCE").otherwise(F.concat(F.lit("X"), F.col("v") % 4)).alias("origin_airport"),
    )
    with settings(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB"}):
        replace_snapshots(lake, rows, "raw", "hot")
    files = lake.table("raw", "hot").select("origin_airport", F.input_file_name().alias("f")).distinct()
    per_airport = {r.origin_airport: r["count"] for r in files.groupBy("origin_airport").count().collect()}
    assert per_airport["NCE"] > 1
    assert lake.table("raw", "hot").count() == ROWS
