"""Compare a Spark result with DuckDB's result of the equivalent SQL."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, connection, sql: str) -> str:
    """Empty when columns and rows agree, else a short description."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} versus {sorted(names)}"
    expected = _bag(names, cursor.fetchall())
    found = _bag(df.columns, [tuple(row) for row in df.collect()])
    if found == expected:
        return ""
    extra, lost = found - expected, expected - found
    return (
        f"{sum(found.values())} rows versus {sum(expected.values())};"
        f" extra {list(extra.items())[:3]}; lost {list(lost.items())[:3]}"
    )
