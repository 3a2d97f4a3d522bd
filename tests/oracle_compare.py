"""Run a registered query and its SQL twin, and compare their rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return "" if value is None else str(value)


def canonical(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs first."""
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    expected_rows = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    expected = canonical(columns, expected_rows)
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    if not got:
        return "no rows" if "empty" not in sql and "< 0" not in sql else None
    for a, b in zip(got, expected):
        if a != b:
            return f"{sorted(columns)}\n got      {a}\n expected {b}"
    return None
