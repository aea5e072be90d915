"""Compare a registered query with its SQL in DuckDB on the same files: names, types in kind, rows, values."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def duck(folder: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def compare(df, con, sql):
    """None when equal, else a short text."""
    got_cols, got = rows_of(df.columns, df.collect())
    res = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}"
    kinds_g = {c: type(v).__name__ for r in got[:50] for c, v in zip(got_cols, r, strict=True) if v is not None}
    kinds_w = {c: type(v).__name__ for r in want[:50] for c, v in zip(want_cols, r, strict=True) if v is not None}
    if kinds_g != kinds_w:
        return f"types {kinds_g} != {kinds_w}"
    return None
