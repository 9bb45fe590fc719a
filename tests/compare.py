"""Run registered queries next to their oracles and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.date()
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return round(value, 9)
    return value


def rows_of(columns, rows):
    """Column names in order, and the rows sorted with their cells in that order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql: str) -> str:
    """Empty when equal, else a short description of the difference."""
    got_cols, got = rows_of(spark_df.columns, spark_df.collect())
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {set(got_cols) ^ set(want_cols)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        diff = {c: (a, b) for c, a, b in zip(got_cols, g, w) if a != b}
        return f"{len(bad)} rows differ, first {diff}"
    return ""
