"""Compare a query with its SQL on the same Parquet files: names, row count, every value."""

from __future__ import annotations

import datetime as dt
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{file}')")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, Decimal)):
        return round(float(value), 4) if isinstance(value, Decimal) else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 4) + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value)


def bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(df, connection, sql: str) -> str | None:
    """None when both give the same rows, else what differs."""
    names = df.columns
    rows = [tuple(row) for row in df.collect()]
    cursor = connection.execute(sql)
    other_names = [d[0] for d in cursor.description]
    other_rows = cursor.fetchall()
    if sorted(names) != sorted(other_names):
        return f"columns {sorted(names)} != {sorted(other_names)}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows != {len(other_rows)} rows"
    ours, theirs = bag(names, rows), bag(other_names, other_rows)
    if ours != theirs:
        return f"only ours {list((ours - theirs))[:3]}, only theirs {list((theirs - ours))[:3]}"
    return None
