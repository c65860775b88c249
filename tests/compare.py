"""Spark result vs DuckDB oracle: row count, column names, and an
order-insensitive comparison of values (columns sorted by name)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

VIEWS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
         "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in VIEWS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def rows_of(columns, records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in t))


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in spark_df.collect()])
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rows_of(d_cols, rel.fetchall())
    result = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
              "columns_match": sorted(s_cols) == sorted(d_cols)}
    mismatches = 0
    first = None
    if len(s_rows) == len(d_rows):
        for a, b in zip(s_rows, d_rows):
            if a != b:
                mismatches += 1
                if first is None:
                    first = (a, b)
    result["value_mismatches"] = mismatches if len(s_rows) == len(d_rows) else None
    result["first_mismatch"] = first
    result["ok"] = (result["columns_match"] and len(s_rows) == len(d_rows) and mismatches == 0)
    if not result["columns_match"]:
        result["columns"] = (sorted(s_cols), sorted(d_cols))
    return result
