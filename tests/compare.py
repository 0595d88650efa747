"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}/*.parquet')" if os.path.isdir(p) else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _value(x):
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (float, Decimal)):
        return "NaN" if math.isnan(x) else f"{float(x):.9g}"
    return str(x)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df, con, sql) -> str:
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want = canon([d[0] for d in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} and {want[0]}"
    if got[1] != want[1]:
        a, b = set(got[1]), set(want[1])
        return f"rows {len(got[1])} and {len(want[1])}; only Spark {sorted(a - b)[:3]}; only SQL {sorted(b - a)[:3]}"
    return ""
