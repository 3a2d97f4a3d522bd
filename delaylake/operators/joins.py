"""Equi joins (J1, J5, J6, J8) and the size check every broadcast goes through."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

HOW = ("left", "inner", "right", "outer")
BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 32 << 20


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes: texts and binaries by their length, anything nested by its text, the rest as 16 bytes."""
    sizes = [F.lit(16 * len(df.columns))]
    for f in df.schema.fields:
        c = F.col("`{}`".format(f.name.replace("`", "``")))
        if isinstance(f.dataType, (StringType, BinaryType)):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            sizes.append(F.coalesce(F.octet_length(c.cast("string")), F.lit(0)))
    return reduce(lambda a, b: a + b, sizes)


def checked_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """``df`` hinted for broadcast when it has at most ``max_rows`` rows of ``max_bytes`` together, else unchanged.

    The check runs at once and stops after ``max_rows`` + 1 rows; a frame that is costly to compute is
    better written first. A larger frame joins by shuffle, where AQE splits hot keys.
    """
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).first()
    return F.broadcast(df) if rows <= max_rows and (size or 0) <= max_bytes else df


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    how: str = "left",
    drop_right_keys: bool = False,
    rename_right: Mapping[str, str] | None = None,
    null_safe: bool = False,
    hot_side: str | None = None,
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Join on ``{left column: right column}``.

    Columns are named as users of data frames expect: a key with one name on both sides appears once,
    other shared names get the suffixes. ``rename_right`` applies before the join.
    ``null_safe=True`` lets NULL keys match NULL keys.

    ``hot_side`` names the side whose keys may repeat without limit; default is the preserved side, and
    both for outer joins. Spark splits a hot key only on the preserved side of an outer join, so for any
    other side the join is written as matched rows plus unmatched rows, and each part can be split.
    """
    if how not in HOW:
        raise ValueError(f"invalid join type {how!r}")
    if not on or not isinstance(on, Mapping):
        raise ValueError("`on` must map left columns to right columns")
    if rename_right:
        right = right.withColumnsRenamed(dict(rename_right))
    hot_side = hot_side or {"left": "left", "right": "right", "inner": "both", "outer": "both"}[how]

    left_columns, right_columns, right_keys = left.columns, right.columns, set(on.values())
    shared_keys = {a for a, b in on.items() if a == b}
    overlap = (set(left_columns) & set(right_columns)) - shared_keys

    # Numbered working names keep both sides apart, whatever they are called outside.
    lcol = {c: f"l_{i}" for i, c in enumerate(left_columns)}
    rcol = {c: f"r_{i}" for i, c in enumerate(right_columns)}
    pairs = [(lcol[a], rcol[b]) for a, b in on.items()]
    joined = _outer_aware_join(
        left.toDF(*lcol.values()), right.toDF(*rcol.values()), pairs, how, null_safe, hot_side
    )

    def named(expression: str, name: str) -> str:
        return "{} AS `{}`".format(expression, name.replace("`", "``"))

    output = []
    for c in left_columns:
        value = lcol[c]
        if c in shared_keys:
            if drop_right_keys:
                continue
            if how == "right":
                value = rcol[c]
            elif how == "outer":
                value = f"coalesce({value}, {rcol[c]})"
        output.append(named(value, c + suffixes[0] if c in overlap else c))
    for c in right_columns:
        if c not in shared_keys and not (drop_right_keys and c in right_keys):
            output.append(named(rcol[c], c + suffixes[1] if c in overlap else c))
    return joined.selectExpr(*output)


def _condition(pairs: Sequence[tuple[str, str]], null_safe: bool) -> Column:
    matches = [F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for a, b in pairs]
    return reduce(lambda x, y: x & y, matches)


def _outer_aware_join(
    lw: DataFrame, rw: DataFrame, pairs: Sequence[tuple[str, str]], how: str, null_safe: bool, hot_side: str
) -> DataFrame:
    condition = _condition(pairs, null_safe)
    one_pass = how == "inner" or (how != "outer" and hot_side == how)
    if one_pass:
        return lw.join(rw, condition, how)
    parts = [lw.join(rw, condition, "inner")]
    if how in ("left", "outer"):
        seen = rw.select([b for _, b in pairs]).distinct()
        parts.append(lw.join(seen, condition, "left_anti"))
    if how in ("right", "outer"):
        seen = lw.select([a for a, _ in pairs]).distinct()
        parts.append(rw.join(seen, condition, "left_anti"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _as_text(df: DataFrame, names: Sequence[str], aliases: Sequence[str]) -> DataFrame:
    return df.select([F.col(n).cast("string").alias(a) for n, a in zip(names, aliases)])


def semi_join(df: DataFrame, keys_of: DataFrame, on: Mapping[str, str], as_text: bool = False) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_of``; ``as_text`` compares the keys as text."""
    return _membership(df, keys_of, on, "left_semi", as_text)


def anti_join(df: DataFrame, keys_of: DataFrame, on: Mapping[str, str], as_text: bool = False) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``keys_of``."""
    return _membership(df, keys_of, on, "left_anti", as_text)


def _membership(df: DataFrame, keys_of: DataFrame, on: Mapping[str, str], how: str, as_text: bool) -> DataFrame:
    aliases = [f"key_{i}" for i in range(len(on))]
    if as_text:
        # Keys are reduced to one row each before the shuffle.
        keys = _as_text(keys_of, list(on.values()), aliases).distinct()
    else:
        keys = keys_of.select([F.col(n).alias(a) for n, a in zip(on.values(), aliases)]).distinct()
    matches = [
        (F.col(n).cast("string") if as_text else F.col(n)) == F.col(a) for n, a in zip(on.keys(), aliases)
    ]
    return df.join(keys, reduce(lambda x, y: x & y, matches), how)


def lookup_with_default(
    df: DataFrame, code_column: str, dimension: Mapping[str, str], output_column: str
) -> DataFrame:
    """Label of a code from a small fixed dictionary; unknown codes show as themselves."""
    pairs = [F.lit(part) for item in dimension.items() for part in item]
    label = F.try_element_at(F.create_map(*pairs), F.col(code_column))
    return df.withColumn(output_column, F.coalesce(label, F.col(code_column)))
