"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
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
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark_df, sql: str, sf_dir: str):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    con = duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    sn, sh, sl = digest(s_cols, s_rows)
    dn, dh, dl = digest(d_cols, d_rows)
    out = {"spark_rows": sn, "duck_rows": dn, "cols_match": sorted(s_cols) == sorted(d_cols),
           "hash_match": sh == dh, "spark_cols": s_cols, "duck_cols": d_cols}
    if sh != dh:
        ss, ds = set(sl), set(dl)
        out["only_spark"] = sorted(ss - ds)[:5]
        out["only_duck"] = sorted(ds - ss)[:5]
    return out
