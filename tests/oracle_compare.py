"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        v = float(v)
        if math.isnan(v):
            return None
        # a nullable integer column reaches pandas as floats from one side, as integers from the other
        return int(v) if v.is_integer() else round(v, 6)
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return int(v)
    return str(v)


def value_hash(df: pd.DataFrame) -> str:
    cols = sorted(df.columns)
    rows = sorted(repr(tuple(_norm(v) for v in r)) for r in df[cols].itertuples(index=False, name=None))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    s = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    d = con.execute(sql).df()
    t2 = time.time()
    s = s.astype(object).where(pd.notna(s), None)
    d = d.astype(object).where(pd.notna(d), None)
    res = {"name": name, "rows": (len(s), len(d)), "spark_s": round(t1 - t0, 2),
           "duck_s": round(t2 - t1, 2),
           "cols_ok": sorted(s.columns) == sorted(d.columns)}
    res["rows_ok"] = len(s) == len(d)
    res["hash_ok"] = res["cols_ok"] and value_hash(s) == value_hash(d)
    if not res["hash_ok"]:
        res["spark_cols"], res["duck_cols"] = list(s.columns), list(d.columns)
        if res["cols_ok"]:
            cols = sorted(s.columns)
            a = {repr(tuple(_norm(v) for v in r)) for r in s[cols].itertuples(index=False, name=None)}
            b = {repr(tuple(_norm(v) for v in r)) for r in d[cols].itertuples(index=False, name=None)}
            res["only_spark"] = sorted(a - b)[:2]
            res["only_duck"] = sorted(b - a)[:2]
    return res
