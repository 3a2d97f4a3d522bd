"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_and_round(c: Column, digits: int = 1) -> Column:
    """Negative values become 0, then half-to-even rounding of the scaled value (2.25 -> 2.2).

    ``bround`` rounds the printed decimal instead, which differs where scaling lands on a tie.
    """
    scale = F.lit(float(10**digits))
    return F.rint(F.greatest(c, F.lit(0.0)) * scale) / scale


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 when ``whole`` is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def percentage(part: Column, whole: Column, digits: int | None = 2) -> Column:
    share = part.cast("double") / whole * 100
    return F.round(share, digits) if digits is not None else share


def elapsed_micros(start: Column, end: Column) -> Column:
    """Microseconds between two ISO texts such as ``2026-03-07T06:00:00Z``."""
    return F.unix_micros(end.try_cast("timestamp")) - F.unix_micros(start.try_cast("timestamp"))


def elapsed_seconds(start: Column, end: Column) -> Column:
    return elapsed_micros(start, end) / F.lit(1e6)
