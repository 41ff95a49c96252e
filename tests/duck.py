"""Side-by-side comparison with DuckDB."""

import os

import duckdb
import pandas as pd


def connect(sf):
    c = duckdb.connect()
    for t in os.listdir(sf):
        p = f"{sf}/{t}"
        c.sql(f"create view {t.removesuffix('.parquet')} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def show(x):
    if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and x != x:
        return "null"
    if isinstance(x, bool) or type(x).__name__ == "bool_":
        return str(bool(x))
    if isinstance(x, (int, float)) or getattr(getattr(x, "dtype", None), "kind", "-") in "fiu":
        return f"{float(x):.6g}"
    return str(x)


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(map(show, r)) for r in df[cols].itertuples(index=False))
