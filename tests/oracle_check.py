"""Run a registered Spark query and its DuckDB oracle on the same tables and compare.

Comparison mirrors the driver: same row count, same column names, and the
same multiset of rows (columns sorted by name, rows sorted). Floats are
compared exactly after normalising -0.0 and NaN.
"""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return 0.0 if v == 0 else v
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    return sorted(out, key=key)


def _tuples(cols, records) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(rec[i]) for i in order) for rec in records]
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    return sorted(out, key=key)


def compare(spark, name: str, spark_df, sql: str, sf_dir: str) -> dict:
    s_cols = list(spark_df.columns)
    s_recs = [tuple(r) for r in spark_df.collect()]
    rel = duck(sf_dir).sql(sql)
    d_cols = list(rel.columns)
    d_recs = rel.fetchall()
    res = {"name": name, "spark_rows": len(s_recs), "oracle_rows": len(d_recs),
           "spark_cols": sorted(s_cols), "oracle_cols": sorted(d_cols)}
    res["rows_match"] = len(s_recs) == len(d_recs)
    res["schema_match"] = sorted(s_cols) == sorted(d_cols)
    if res["schema_match"]:
        rs, rd = _tuples(s_cols, s_recs), _tuples(d_cols, d_recs)
        res["values_match"] = rs == rd
        if not res["values_match"]:
            diffs = []
            for a, b in zip(rs, rd):
                if a != b:
                    diffs.append((a, b))
                    if len(diffs) >= 3:
                        break
            res["first_diffs"] = diffs
    else:
        res["values_match"] = False
    return res
