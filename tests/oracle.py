"""Compare a query with its DuckDB SQL: columns by name, rows in any order, values exactly."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v: object) -> object:
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    ran = con.execute(sql)
    names = [c[0] for c in ran.description]
    want = _sorted_rows(names, ran.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}", f"first {got[:2]} / {want[:2]}"]
    return [f"{g}\n   != {w}" for g, w in zip(got, want) if g != w]
