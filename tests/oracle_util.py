"""Spark-vs-DuckDB comparison used by the oracle tests and tools/oracle_check.py."""
from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v          # exact: the oracle reproduces Spark's arithmetic
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


def compare(spark_df, con, sql):
    """Return (ok, message)."""
    s_cols = sorted(spark_df.columns)
    s_rows = rows([r.asDict() for r in spark_df.collect()], s_cols)
    res = con.execute(sql)
    d_cols_raw = [d[0] for d in res.description]
    d_rows = rows([dict(zip(d_cols_raw, r)) for r in res.fetchall()], sorted(d_cols_raw))
    if s_cols != sorted(d_cols_raw):
        return False, f"columns differ: {s_cols} vs {sorted(d_cols_raw)}"
    if s_rows != d_rows:
        only_s = [r for r in s_rows if r not in set(d_rows)][:3]
        only_d = [r for r in d_rows if r not in set(s_rows)][:3]
        return False, f"rows differ ({len(s_rows)} vs {len(d_rows)}): spark-only {only_s} duck-only {only_d}"
    return True, f"{len(s_rows)} rows"
