"""Calendar parts of dates and timestamps (F1-F6). NULL in, NULL out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..constants import LOCAL_TIME_ZONE


def day_of_week(date: Column) -> Column:
    """Monday = 1 ... Sunday = 7 (``dayofweek`` would start the week on Sunday)."""
    return F.weekday(date) + 1


def month_number(date: Column) -> Column:
    return F.month(date)


def day_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMMM")


def local_hour(df: DataFrame, column: str, zone: str = LOCAL_TIME_ZONE) -> Column:
    """Hour of day in ``zone`` for instants; a timestamp without zone gives its own hour."""
    if isinstance(df.schema[column].dataType, TimestampNTZType):
        return F.hour(F.col(column))
    return F.hour(F.from_utc_timestamp(F.col(column), zone))
