"""Type conversions that give NULL instead of failing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE_NUMBER = r"^[+-]?[0-9]+$"
_DECIMAL_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_LONG_LIMIT = 9.2e18


def to_utc_timestamp(c: Column) -> Column:
    """Instant in UTC; text without an offset is read as UTC (the session zone)."""
    return c.try_cast("timestamp")


def to_calendar_date(c: Column) -> Column:
    return c.try_cast("date")


def to_text(c: Column, null_literal: str | None = None) -> Column:
    """Text form. ``null_literal="None"`` spells NULL out, as an object-to-text cast in pandas does."""
    text = c.cast("string")
    return F.coalesce(text, F.lit(null_literal)) if null_literal is not None else text


def to_integer(c: Column) -> Column:
    """Nullable 64-bit integer. ``'null'``, junk and fractions give NULL; ``' 12 '`` and ``'1e3'`` are numbers.

    A plain ``try_cast`` to bigint would cut 93.5 to 93 and reject 1e3.
    """
    text = F.trim(c.cast("string"))
    number = F.when(text.rlike(_DECIMAL_NUMBER), text.try_cast("double"))
    return F.when(text.rlike(_WHOLE_NUMBER), text.try_cast("bigint")).when(
        (number == F.floor(number)) & (F.abs(number) < _LONG_LIMIT), number.cast("bigint")
    )


def bool_map(c: Column, mapping: Mapping[str, bool]) -> Column:
    """Boolean by value; values outside ``mapping`` and NULL give NULL."""
    truths = [value for value, flag in mapping.items() if flag]
    falses = [value for value, flag in mapping.items() if not flag]
    return F.when(c.isin(truths), F.lit(True)).when(c.isin(falses), F.lit(False))
