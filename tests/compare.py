"""Runs a registered query and its SQL statement on the same files and compares all rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(directory).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return float(v) if v != v.to_integral_value() else float(int(v))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    if isinstance(v, datetime):
        return v.isoformat(sep=" ", timespec="microseconds")
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str:
    """Empty text when both sides agree."""
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = rows_of(want_cols, cur.fetchall())
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} vs {sorted(want_cols)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return ""
    extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
    return f"{sum(got.values())} vs {sum(want.values())} rows\n cols  {sorted(want_cols)}\n only spark {extra}\n only sql   {missing}"
