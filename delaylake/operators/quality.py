"""Counts, null rates, gates and readiness."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..constants import EXPECTED_AIRPORTS, READINESS_HOURS
from .filters import recent


def count_stage(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass here while the plan runs anyway; read the result after an action."""
    observation = Observation(stage)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def observed(observation: Observation, df: DataFrame, metrics: Sequence[Column]) -> dict:
    """The metrics observed while ``df`` was written.

    Spark runs no task for a frame it knows to be empty, and then observes nothing; the metrics are
    computed directly in that case.
    """
    try:
        return observation.get
    except Py4JError:
        return df.agg(*metrics).first().asDict()


def observed_head(df: DataFrame, rows: int = 5, name: str = "head") -> tuple[DataFrame, Observation]:
    """``df``, and an observation of its first rows, taken while ``df`` is written or otherwise computed.

    Each of the first ``rows`` places is one minimum over all tasks, so a preview costs no second job and never more than
    ``rows`` rows, whatever the number of tasks. Where the first task with rows has so many, it is the head of the frame.
    ``head_rows`` reads it.
    """
    place = F.monotonically_increasing_id()
    within = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), _HEAD_OPTIONS)
    # Only the first rows of a task become text.
    marked = df.withColumn("__place", place).withColumn("__row", F.when(within < rows, F.struct("__place", text)))
    observation = Observation(name)
    firsts = [F.min(F.when(within == i, F.col("__row"))).alias(f"row_{i}") for i in range(rows)]
    return marked.observe(observation, *firsts).drop("__place", "__row"), observation


_HEAD_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def head_rows(df: DataFrame, observation: Observation) -> DataFrame:
    """What ``observed_head`` saw, as a frame of the schema of ``df``; empty when nothing was."""
    try:
        seen = sorted(tuple(v) for v in observation.get.values() if v is not None)
    except Py4JError:  # nothing is observed of a frame known to be empty
        seen = []
    spark = df.sparkSession
    texts = spark.createDataFrame([(text,) for _, text in seen], "row string")
    return texts.select(F.from_json("row", df.schema, _HEAD_OPTIONS).alias("r")).select("r.*")


def null_profile(
    df: DataFrame, columns: Iterable[str] | None = None, threshold_percent: float | None = None
) -> DataFrame:
    """NULL count and percentage per column in one pass; empty input gives no rows.

    NaN counts as NULL. ``breached`` marks columns strictly above the threshold.
    """
    columns = list(columns or df.columns)

    def missing(name: str) -> Column:
        c = F.col(f"`{name}`")
        may_be_nan = isinstance(df.schema[name].dataType, (FloatType, DoubleType))
        return c.isNull() | F.isnan(c) if may_be_nan else c.isNull()

    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(missing(c)).alias(f"n_{i}") for i, c in enumerate(columns)]
    )
    profile = counts.filter(F.col("rows") > 0).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(f"n_{i}").alias("null_count"),
                        F.round(F.col(f"n_{i}") * 100.0 / F.col("rows"), 2).alias("null_percent"),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )
    limit = F.lit(None).cast("double") if threshold_percent is None else F.lit(float(threshold_percent))
    return profile.withColumn("breached", F.coalesce(F.col("null_percent") > limit, F.lit(False)))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Refuse an empty frame; runs a job that stops at the first row."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def require_min_rows(df: DataFrame, minimum: int, what: str) -> DataFrame:
    """Refuse a frame of fewer than ``minimum`` rows; counts no further than that."""
    found = df.limit(minimum).count()
    if found < minimum:
        raise ValueError(f"{what} has {found} rows, {minimum} are needed")
    return df


def missing_values(df: DataFrame, column: str, expected: Sequence[str] = EXPECTED_AIRPORTS) -> DataFrame:
    """Expected values that do not occur in ``column``.

    Values outside the expected list are filtered at the scan, so the distinct side has at most as many
    rows as the list and may be broadcast.
    """
    spark = df.sparkSession
    wanted = spark.createDataFrame([(v,) for v in expected], f"{column} string")
    found = df.filter(F.col(column).isin(list(expected))).select(column).distinct()
    return wanted.join(F.broadcast(found), column, "left_anti")


def readiness(
    tables: Mapping[str, tuple[DataFrame, str]],
    expected: Sequence[str] = EXPECTED_AIRPORTS,
    as_of: Column | None = None,
    hours: int = READINESS_HOURS,
    time_column: str = "execution_date",
) -> DataFrame:
    """One row per table and missing airport; no rows means everything expected arrived recently."""
    parts = [
        missing_values(recent(df, time_column, hours, as_of), key, expected).select(
            F.lit(name).alias("table_name"), F.col(key).alias("missing")
        )
        for name, (df, key) in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
