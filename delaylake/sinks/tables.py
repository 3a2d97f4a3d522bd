"""Plain table loads (K1)."""

from __future__ import annotations

from pyspark.sql import DataFrame

_SAVE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def load_table(df: DataFrame, table: str, if_exists: str = "append") -> None:
    """Load into a table; an empty input is refused (at most one row is read to find out)."""
    if if_exists not in _SAVE_MODES:
        raise ValueError(f"unknown if_exists {if_exists!r}")
    if df.isEmpty():
        raise ValueError(f"nothing to load into {table}")
    writer = df.write.format("parquet").mode(_SAVE_MODES[if_exists])
    if if_exists == "replace":
        writer = writer.option("partitionOverwriteMode", "static")
    writer.saveAsTable(table)


def jdbc_load(
    df: DataFrame,
    url: str,
    table: str,
    if_exists: str = "append",
    batch_rows: int = 1000,
    properties: dict[str, str] | None = None,
) -> None:
    """Load into an external database, ``batch_rows`` rows per insert statement."""
    (
        df.write.format("jdbc")
        .mode(_SAVE_MODES[if_exists])
        .options(**(properties or {}))
        .options(url=url, dbtable=table, batchsize=str(batch_rows))
        .save()
    )
