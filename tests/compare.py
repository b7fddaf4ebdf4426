"""Local check: run a registered query in Spark and its SQL in DuckDB on the
same parquet files and compare row count, column names and the multiset of rows."""

from __future__ import annotations

import datetime as _dt
import math
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    # exact: both sides round to 6 digits themselves; repr keeps the sign of zero
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None)
    return v


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from tarmac.plans.registry import ORACLE, QUERIES
    df = QUERIES[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duckdb_conn(sf_dir)
    res = con.execute(ORACLE[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "cols_match": sorted(s_cols) == sorted(o_cols)}
    if out["cols_match"]:
        order = sorted(range(len(o_cols)), key=lambda i: o_cols[i])
        s_idx = [s_cols.index(o_cols[i]) for i in order]
        sc = Counter(tuple(_norm(r[i]) for i in s_idx) for r in s_rows)
        oc = Counter(tuple(_norm(r[i]) for i in order) for r in o_rows)
        out["values_match"] = sc == oc
        if not out["values_match"]:
            out["spark_only"] = list((sc - oc).items())[:3]
            out["oracle_only"] = list((oc - sc).items())[:3]
    else:
        out["spark_cols"], out["oracle_cols"] = s_cols, o_cols
        out["values_match"] = False
    return out
