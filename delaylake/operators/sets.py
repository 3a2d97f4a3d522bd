"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_by_name(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both, aligned by name; columns missing on one side are NULL there."""
    return first.unionByName(second, allowMissingColumns=True)


def except_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct rows of the first that the second does not have."""
    return first.subtract(second)


def intersect_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct rows both have."""
    return first.intersect(second)
