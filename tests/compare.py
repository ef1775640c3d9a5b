"""Compares a Spark result with DuckDB's over the same parquet files."""

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, connection, sql, limit=5):
    """Empty when columns and rows agree, else a description."""
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    expected = _rows(columns, result.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if expected == actual:
        return ""
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"only Spark {list(extra)[:limit]}; only SQL {list(missing)[:limit]}"
    )
