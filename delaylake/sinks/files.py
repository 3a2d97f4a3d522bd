"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, require_rows: bool = False) -> None:
    """Parquet output; an empty frame keeps its schema. ``require_rows`` refuses an empty frame."""
    if require_rows and df.isEmpty():
        raise ValueError(f"nothing to write to {path}")
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_by_key(df: DataFrame, path: str, key: str) -> None:
    """One folder per key value; AQE cuts a hot key into several files."""
    df.hint("rebalance", key).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        key
    ).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_text(df: DataFrame, path: str) -> None:
    """A single text column, one line per row."""
    df.write.mode("overwrite").text(path)
