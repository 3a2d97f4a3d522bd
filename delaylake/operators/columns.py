"""Column-level operators (P1-P7, F15-F20 over several columns, U1, U2)."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions import bool_map, braces_to_value, to_calendar_date, to_integer, to_text, to_utc_timestamp

logger = logging.getLogger(__name__)


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the columns that exist; others are ignored."""
    names = list(names)
    if not any(n in df.columns for n in names):
        logger.warning("none of the columns %s exists", names)
    return df.drop(*names)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def select_features(df: DataFrame, features: Sequence[str], lenient: bool = False) -> DataFrame:
    """The feature columns; with ``lenient`` those that exist, in the given order."""
    missing = [f for f in features if f not in df.columns]
    if missing and not lenient:
        raise ValueError(f"missing features {missing}")
    if missing:
        logger.warning("missing features ignored: %s", missing)
    return df.select([f for f in features if f in df.columns])


def add_snapshot_columns(
    df: DataFrame,
    dag_id: str,
    instance_id: str,
    logical_date: dt.datetime | Column | None = None,
    data_interval_start: dt.datetime | Column | None = None,
    run_date: dt.datetime | Column | None = None,
    date_column: str = "date_photo",
    week_column: str = "semaine_photo",
    year_column: str = "annee_photo",
    execution_column: str = "execution_date",
    instance_column: str = "instance_id",
    iso_year_column: str | None = None,
) -> DataFrame:
    """Stamp every row with its load: ISO week next to calendar year, as the tables have always had.

    The load time is the first one given of the three, else now. Times without a zone are UTC.
    """
    candidates = [_instant(c) for c in (logical_date, data_interval_start, run_date) if c is not None]
    when = F.coalesce(*candidates, F.current_timestamp())
    stamped = {
        "dag_id": F.lit(dag_id),
        execution_column: when,
        date_column.lower(): when.cast("date"),
        week_column.lower(): F.weekofyear(when),
        year_column.lower(): F.year(when),
        instance_column: F.lit(instance_id),
    }
    if iso_year_column:
        stamped[iso_year_column] = F.extract(F.lit("YEAROFWEEK"), when).cast("int")
    return df.withColumns(stamped)


def _instant(value: dt.datetime | Column) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp")
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return F.lit(value.isoformat()).cast("timestamp")


@dataclass(frozen=True)
class BatchFunction:
    """A Python function of whole pandas columns, a batch of rows at a time, for logic no built-in expresses.

    It gets a frame and gives a series. Prefer a ``Column``: this one leaves the JVM.
    """

    function: Callable
    returns: str | DataType
    args: tuple = ()
    kwargs: dict = field(default_factory=dict)

    def over(self, df: DataFrame) -> Column:
        function, args, kwargs = self.function, self.args, self.kwargs

        @F.pandas_udf(self.returns)
        def call(rows: pd.DataFrame) -> pd.Series:
            return function(rows, *args, **kwargs)

        return call(F.struct(*[F.col(f"`{c}`") for c in df.columns]))


@dataclass(frozen=True)
class RowFunction:
    """Adapter for existing functions of one row; it calls Python once per row, so ``BatchFunction`` is the form to write."""

    function: Callable
    returns: str | DataType
    args: tuple = ()
    kwargs: dict = field(default_factory=dict)

    def over(self, df: DataFrame) -> Column:
        function, args, kwargs = self.function, self.args, self.kwargs

        @F.pandas_udf(self.returns)
        def call(rows: pd.DataFrame) -> pd.Series:
            return rows.apply(lambda row: function(row, *args, **kwargs), axis=1).astype(object)

        return call(F.struct(*[F.col(f"`{c}`") for c in df.columns]))


ColumnRule = Column | Callable[[DataFrame], Column] | BatchFunction | RowFunction


def apply_columns(df: DataFrame, rules: Mapping[str, ColumnRule]) -> DataFrame:
    """Add derived columns in order; later rules see earlier columns. Other values are skipped."""
    for name, rule in rules.items():
        if isinstance(rule, (BatchFunction, RowFunction)):
            df = df.withColumn(name, rule.over(df))
        elif isinstance(rule, Column):
            df = df.withColumn(name, rule)
        elif callable(rule):
            df = df.withColumn(name, rule(df))
        else:
            logger.warning("%s: neither a column nor a function, skipped", name)
    return df


def apply_frame_function(df: DataFrame, function: Callable, schema: str | None = None) -> DataFrame:
    """Table-to-table hook. With ``schema`` the function gets pandas batches inside the tasks."""
    if schema is None:
        return df.transform(function)

    def batches(frames):
        for frame in frames:
            yield function(frame)

    return df.mapInPandas(batches, schema)


def convert_dates(df: DataFrame, timestamps: Iterable[str] = (), dates: Iterable[str] = ()) -> DataFrame:
    """Text to UTC timestamps and calendar dates; invalid values become NULL, unknown columns are skipped."""
    rules = {c: to_utc_timestamp(F.col(c)) for c in timestamps if c in df.columns}
    rules |= {c: to_calendar_date(F.col(c)) for c in dates if c in df.columns}
    return df.withColumns(rules)


def convert_types(
    df: DataFrame,
    texts: Iterable[str] = (),
    integers: Iterable[str] = (),
    booleans: Mapping[str, Mapping[str, bool]] | None = None,
    null_literal: str | None = None,
) -> DataFrame:
    """Text, nullable integer and mapped boolean columns; unknown columns are skipped."""
    rules = {c: to_text(F.col(c), null_literal) for c in texts if c in df.columns}
    rules |= {c: to_integer(F.col(c)) for c in integers if c in df.columns}
    rules |= {c: bool_map(F.col(c), m) for c, m in (booleans or {}).items() if c in df.columns}
    return df.withColumns(rules)


def extract_array_text(df: DataFrame, columns: Iterable[str], target: str = "int") -> DataFrame:
    """``{...}`` text columns to values; unknown columns are skipped."""
    return df.withColumns({c: braces_to_value(F.col(c), target) for c in columns if c in df.columns})
