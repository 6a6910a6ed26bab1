"""Compare a query with its SQL in DuckDB on the same files."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _kind(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_kind(r[i]) for i in order) for r in rows)


def oracle_rows(con, sql: str):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return columns, cur.fetchall()


def kinds(columns, rows) -> dict[str, set[str]]:
    return {
        c: {type(r[i]).__name__ for r in rows if r[i] is not None} for i, c in enumerate(columns)
    }


def difference(df, con, sql: str) -> str | None:
    """None when rows, column names and value types agree."""
    want_cols, want = oracle_rows(con, sql)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    if sorted(want_cols) != sorted(got_cols):
        return f"columns {got_cols} != {want_cols}"
    a, b = kinds(got_cols, got), kinds(want_cols, want)
    if a != b:
        return f"types differ: {({c: (a[c], b[c]) for c in a if a[c] != b[c]})}"
    x, y = rows_of(got_cols, got), rows_of(want_cols, want)
    if x != y:
        extra, missing = list((x - y).items())[:3], list((y - x).items())[:3]
        return f"{len(got)} vs {len(want)} rows; extra {extra}; missing {missing}"
    return None
