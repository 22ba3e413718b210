"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names (sorted), and an order-insensitive multiset of rows
with every value rendered as text."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, _dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark_df, con, sql: str):
    """-> dict(match, rows_spark, rows_oracle, cols_spark, cols_oracle, diff)"""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    o_cols = list(rel.columns)
    o_rows = rel.fetchall()
    s, sc = rows_of(s_cols, s_rows)
    o, oc = rows_of(o_cols, o_rows)
    diff = []
    if s != o:
        ss, os_ = set(s), set(o)
        diff = [("spark_only", r) for r in list(ss - os_)[:3]] + [("oracle_only", r) for r in list(os_ - ss)[:3]]
    return {
        "match": sc == oc and s == o,
        "rows_spark": len(s),
        "rows_oracle": len(o),
        "cols_spark": sc,
        "cols_oracle": oc,
        "diff": diff,
    }
