"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(folder, table)}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sortable(row):
    return tuple((v is not None, str(type(v)) if v is not None else "", v) for v in row)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(body, key=_sortable)


def compare(spark, con, plan, sql, folder):
    df = plan(spark, folder)
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    done = con.execute(sql)
    theirs = canonical([d[0] for d in done.description], done.fetchall())
    assert mine[0] == theirs[0], (mine[0], theirs[0])
    assert len(mine[1]) == len(theirs[1]), (len(mine[1]), len(theirs[1]))
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    assert not wrong, (len(wrong), wrong[:3])
    return df, done, len(mine[1])
