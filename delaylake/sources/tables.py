"""Table scans, incremental by watermark where wanted."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from ..sinks.lake import Lake

logger = logging.getLogger(__name__)


def table_scan(
    spark: SparkSession,
    table: str,
    columns: str | list[str] = "*",
    where: str | None = None,
    limit: int | None = None,
    query: str | None = None,
) -> DataFrame:
    """Columns, condition and limit over a table; ``query`` replaces all of them."""
    if query:
        return spark.sql(query)
    if isinstance(columns, str):
        columns = columns.split(",")
    df = spark.table(table)
    if where:
        df = df.where(where)
    df = df.select([name.strip() for name in columns])
    return df.limit(limit) if limit else df


def incremental_scan(
    lake: Lake,
    layer: str,
    table: str,
    columns: str | list[str] = "*",
    where: str | None = None,
    query: str | None = None,
) -> DataFrame:
    """Rows of the last loaded snapshot only.

    The watermark becomes a literal on the partition column, so other snapshots are not even listed.
    A given ``where`` or ``query`` switches it off; without a watermark the whole table is read.
    """
    scan = table_scan(lake.spark, lake.view(layer, table), columns, where, query=query)
    if where or query:
        return scan
    watermark = lake.watermark(layer, table)
    if watermark is None:
        logger.warning("no watermark for %s.%s: full scan", layer, table)
        return scan
    return table_scan(lake.spark, lake.view(layer, table), columns, f"date_photo = DATE'{watermark}'")


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: str | int,
    upper: str | int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Parallel read of an external database table, split by ranges of ``partition_column``."""
    return (
        spark.read.format("jdbc")
        .options(**(properties or {}))
        .options(
            url=url,
            dbtable=table,
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
        .load()
    )
