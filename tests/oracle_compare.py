"""Compare a Spark result with its DuckDB oracle: names, row count and every value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    """Type-tagged value: an int never equals a float or a string."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("null", "")
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, int):
        return ("int", str(value))
    if isinstance(value, float):
        return ("float", repr(value + 0.0))
    return (type(value).__name__, str(value))


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in data)


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    left, right = rows(df.columns, df.collect()), rows(names, expected.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows, expected {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(right)} rows differ, first: {wrong[0]}" if wrong else None
