"""Distinct, sort, first match and best-of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_sorted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


def sort_nulls_last(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.orderBy([F.col(c).asc_nulls_last() for c in columns])


def first_match(df: DataFrame, condition: Column, order_by: Sequence[str]) -> DataFrame:
    """At most one row, always the same one: the first in ``order_by`` order."""
    return df.filter(condition).orderBy(*order_by).limit(1)


def best_of(df: DataFrame, metric: str, direction: str = "max", by: Sequence[str] = (), tie_break: Sequence[str] = ()) -> DataFrame:
    """The row with the best metric, per group with ``by``; an aggregate, so no group is sorted.

    Ties go to the smallest ``tie_break``. Rows without metric never win.
    """
    if direction not in ("max", "min"):
        raise ValueError(f"unknown direction {direction!r}")
    metric_order = F.col(metric) if direction == "min" else -F.col(metric)
    order = F.struct(metric_order, *tie_break)
    others = [c for c in df.columns if c not in by]
    best = (
        df.filter(F.col(metric).isNotNull()).groupBy(*by).agg(F.min_by(F.struct(*others), order).alias("best"))
    )
    return best.filter(F.col("best").isNotNull()).select(
        [F.col(c) if c in by else F.col(f"best.{c}").alias(c) for c in df.columns]
    )


def best_tag(
    df: DataFrame, tags: str, tag: str, direction: str = "max", by: Sequence[str] = (), name: str = "best"
) -> DataFrame:
    """Best numeric value of a tag over versions; 0 (max) or infinity (min) when no version carries it."""
    value = F.try_element_at(F.col(tags), F.lit(tag)).try_cast("double")
    if direction == "max":
        best = F.coalesce(F.max(value), F.lit(0.0))
    else:
        best = F.coalesce(F.min(value), F.lit(float("inf")))
    return df.groupBy(*by).agg(best.alias(name))
