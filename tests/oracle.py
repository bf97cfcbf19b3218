"""Comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r))


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Number of rows, and what differs."""
    expected = con.sql(sql)
    problems = []
    if sorted(df.columns) != sorted(expected.columns):
        return 0, [f"columns {sorted(df.columns)} != {sorted(expected.columns)}"]
    got, want = rows_of(df.columns, df.collect()), rows_of(expected.columns, expected.fetchall())
    if len(got) != len(want):
        problems.append(f"{len(got)} rows != {len(want)}")
    differing = [(g, w) for g, w in zip(got, want) if g != w or list(map(type, g)) != list(map(type, w))]
    if differing:
        problems.append(f"{len(differing)} rows differ, first {differing[0]}")
    return len(got), problems
