"""Repeatable train/test split (M1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import SEED, TEST_SHARE
from ..operators.joins import checked_broadcast
from ..session import written


def with_split(
    df: DataFrame,
    key: Sequence[str],
    label: str | None = None,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    output: str = "is_test",
) -> DataFrame:
    """Mark ``test_share`` of the rows of every label (or of all rows) as test rows.

    A row's bucket is a hash of its key, so the split survives repartitioning and reruns, and copies of
    one key stay on one side. A histogram of buckets per label, at most 65536 rows each, gives the
    bucket where the share is reached: the data is never sorted and no label is gathered in one task.
    The share is exact to one bucket. The histogram is computed at once, as its cuts are broadcast.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    # The first four hex digits of the digest: 0 .. 65535.
    bucket = F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int")
    group = F.col(label).cast("string") if label else F.lit("all")
    marked = df.withColumns({"split_group": group, "split_bucket": bucket})
    histogram = marked.groupBy("split_group", "split_bucket").agg(F.count(F.lit(1)).alias("n"))
    per_group = Window.partitionBy("split_group")
    running = histogram.withColumns(
        {
            "before": F.sum("n").over(per_group.orderBy("split_bucket")) - F.col("n"),
            "wanted": F.ceil(F.sum("n").over(per_group) * F.lit(test_share)),
        }
    )
    cuts = (
        running.filter(F.col("before") < F.col("wanted"))
        .groupBy(F.col("split_group").alias("cut_group"))
        .agg(F.max("split_bucket").alias("cut_bucket"))
    )
    return (
        marked.join(checked_broadcast(written(cuts, "split")), F.col("split_group").eqNullSafe(F.col("cut_group")), "left")
        .withColumn(output, F.col("split_bucket") <= F.col("cut_bucket"))
        .drop("split_group", "split_bucket", "cut_group", "cut_bucket")
    )


def stratified_split(
    df: DataFrame,
    key: Sequence[str],
    label: str | None = None,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Train rows and test rows."""
    marked = with_split(df, key, label, test_share, seed)
    return marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")
