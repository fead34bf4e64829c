"""Runs registered queries against DuckDB on the same parquet files."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{Path(folder) / table}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    return [columns[i].lower() for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql) -> str | None:
    """None if equal, else what differs."""
    ours = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    theirs = canonical([c[0] for c in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}: {ours[1][:2]} / {theirs[1][:2]}"
    unequal = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(unequal)} of {len(ours[1])} rows differ, first {unequal[0]}" if unequal else None
