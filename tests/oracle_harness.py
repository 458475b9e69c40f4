"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's gate:
row count, column names, order-insensitive value hash)."""

from __future__ import annotations

import hashlib
import math

import duckdb

from revlens.sources.tables import TABLES


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{v:.6f}"
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run_duck(con, sql: str):
    rel = con.sql(sql)
    cols = rel.columns
    return cols, rel.fetchall()


def compare(spark, fn, sql, sf_dir, con=None):
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck_connect(sf_dir)
    d_cols, d_rows = run_duck(con, sql)
    out = {"spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols), "spark_cols": s_cols, "duck_cols": d_cols}
    hs, ls = digest(s_cols, s_rows)
    hd, ld = digest(d_cols, d_rows)
    out["hash_match"] = hs == hd
    if hs != hd:
        sd = sorted(set(ls) - set(ld))[:3]
        dd = sorted(set(ld) - set(ls))[:3]
        out["spark_only"] = sd
        out["duck_only"] = dd
    return out
