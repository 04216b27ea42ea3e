"""Spark-vs-DuckDB comparison in the manner of the driver's correctness gate:
row count, column names and an order-insensitive multiset of values."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
                 "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def normalized_rows(rows, columns, digits=9):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql, digits=9):
    """Return (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a = normalized_rows(s_rows, s_cols, digits)
    b = normalized_rows(d_rows, d_cols, digits)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({sum(1 for x, y in zip(a, b) if x != y)} rows), e.g. {diffs}"
    exact = normalized_rows(s_rows, s_cols, 17) == normalized_rows(d_rows, d_cols, 17)
    return True, f"{len(s_rows)} rows" + ("" if exact else " (floats equal to 9 digits only)")
