"""Compare registered queries with their SQL in DuckDB, order-insensitively."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return ("", "null")
    if isinstance(value, float):
        return ("float", repr(round(value, 9)))
    if isinstance(value, pd.Timestamp):
        value = value.to_pydatetime()
    return (type(value).__name__, str(value))


def rows(columns, data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in data)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows(columns, result.fetchall())
