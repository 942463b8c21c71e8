"""Spark results against DuckDB results on the same tables, whatever their order."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


def cell(x):
    if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and x != x:
        return None
    if isinstance(x, float):
        return f"{x:.9g}"
    if hasattr(x, "tolist") and getattr(x, "ndim", 0):
        return repr(x.tolist())
    return f"{float(x):.9g}" if isinstance(x, int) and not isinstance(x, bool) else str(x)


def canon(df):
    return sorted((tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)
