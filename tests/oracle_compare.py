"""Compare a Spark query with its DuckDB oracle: row count, column names and
an order-insensitive multiset of rows (columns sorted by name)."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.12g}")
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return cols, out


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols = spark_df.columns
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    sc, sr = normalise(s_cols, s_rows)
    dc, dr = normalise(d_cols, d_rows)
    if sc != dc:
        return False, f"columns differ: spark={sc} duckdb={dc}"
    if len(sr) != len(dr):
        return False, f"row counts differ: spark={len(sr)} duckdb={len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            return False, f"first differing row: spark={a} duckdb={b}"
    return True, f"{len(sr)} rows equal"
