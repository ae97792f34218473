"""Runs a query in both engines over one data directory and compares normalised rows."""

import datetime
import decimal
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
    return con


def norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, decimal.Decimal)):
        return float(v)
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([norm(r[i]) for i in order] for r in data), key=repr)


def compare(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    rel = con.execute(sql)
    want_cols = [d[0] for d in rel.description]
    want = rows(want_cols, rel.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(df.columns) == sorted(want_cols)
    assert len(got) == len(want), (len(got), len(want))
    assert got == want, next((a, b) for a, b in zip(got, want) if a != b)
