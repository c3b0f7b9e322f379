"""Order-free comparison of a Spark result with a DuckDB one."""

from __future__ import annotations

from pathlib import Path

import duckdb

from registered.oracle import TABLES


def duck(root: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(root, f"{name}.parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def normal(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(repr(normal(row[n])) for n in names) for row in df.collect()]
    return names, sorted(rows)


def duck_rows(connection, sql: str):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    places = [columns.index(n) for n in names]
    rows = [tuple(repr(normal(row[p])) for p in places) for row in result.fetchall()]
    return names, sorted(rows)
