"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's check):
row count, column names, and an order-insensitive comparison of values."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return repr(v)  # exact: also tells -0.0 from 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    info = {"spark_rows": len(s_rows), "duck_rows": len(d_rows),
            "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not info["cols_match"]:
        info["only_spark"] = sorted(set(s_cols) - set(d_cols))[:10]
        info["only_duck"] = sorted(set(d_cols) - set(s_cols))[:10]
        info["match"] = False
        return info
    a, b = rows_key(s_rows, s_cols), rows_key(d_rows, d_cols)
    info["match"] = a == b
    if not info["match"] and len(a) == len(b):
        names = sorted(s_cols)
        for x, y in zip(a, b):
            if x != y:
                info["first_diff"] = [(n, p, q) for n, p, q in zip(names, x, y) if p != q][:6]
                break
    return info
