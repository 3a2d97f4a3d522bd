"""One row per key.

``row_number() == 1`` lets Spark keep the best row per key in every task before the shuffle, so a key
that holds a third of the table sends one row per task and not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    numbered = df.withColumn("row_in_key", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col("row_in_key") == 1).drop("row_in_key")


def drop_duplicates(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], keep: str | bool = "last"
) -> DataFrame:
    """Keep the last or first row per key in ``order_by`` order; ``keep=False`` drops repeated keys altogether.

    Tables have no file order, so the order has to be named, and should be total for a repeatable
    result. NULL is a key value like any other.
    """
    if keep is False:
        # At most two rows of a key leave a task: enough to tell it is repeated.
        by_key = Window.partitionBy(*keys)
        few = df.withColumn("row_in_key", F.row_number().over(by_key.orderBy(F.lit(0)))).filter("row_in_key <= 2")
        single = few.withColumn("rows_of_key", F.count(F.lit(1)).over(by_key)).filter("rows_of_key = 1")
        return single.select(df.columns)
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    if not order_by:
        raise ValueError("order_by is required")
    order = [F.col(c).asc_nulls_first() if keep == "first" else F.col(c).desc_nulls_last() for c in order_by]
    return _first_per_key(df, keys, order)


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    date_column: str,
    tie_break: Sequence[str],
    null_wins: bool = True,
) -> DataFrame:
    """Newest row per key by ``date_column``, ties decided by ``tie_break`` (larger first).

    A row without date counts as newest, as sorting puts it last; ``null_wins=False`` makes it oldest.
    """
    if date_column not in df.columns:
        raise ValueError(f"column {date_column!r} not found")
    date = F.col(date_column)
    order = [date.desc_nulls_first() if null_wins else date.desc_nulls_last()]
    order += [F.col(c).desc_nulls_last() for c in tie_break]
    return _first_per_key(df, keys, order)
