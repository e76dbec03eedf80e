"""Comparing a Spark result with its DuckDB counterpart, order aside."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark, folder: str, run, sql: str, con=None) -> int:
    """Assert equality; returns the number of rows."""
    df = run(spark, folder)
    mine = normalized(df.columns, [tuple(r) for r in df.collect()])
    result = (con or connect(folder)).execute(sql)
    theirs = normalized([c[0] for c in result.description], result.fetchall())
    assert mine[0] == theirs[0], (mine[0], theirs[0])
    if mine[1] != theirs[1]:
        a, b = set(map(repr, mine[1])), set(map(repr, theirs[1]))
        raise AssertionError(f"{len(mine[1])} vs {len(theirs[1])} rows; only Spark: "
                             f"{sorted(a - b)[:2]}; only SQL: {sorted(b - a)[:2]}")
    return len(mine[1])
