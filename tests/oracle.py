"""Run one registered query and its SQL over the same folder and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{folder}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as plain values, columns by name, rows sorted."""
    def plain(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float) and v == int(v) and abs(v) < 1e15:
            return float(v)
        return v
    cols = sorted(df.columns)
    rows = [tuple(plain(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} vs {len(sql_df)}"
    for c in spark_df.columns:
        a, b = spark_df[c].dtype, sql_df[c].dtype
        if a != b:
            return f"column {c}: type {a} vs {b}"
    left, right = canonical(spark_df), canonical(sql_df)
    for i, (a, b) in enumerate(zip(left, right)):
        if a != b:
            return f"row {i}: {str(a)[:300]} vs {str(b)[:300]}"
    return None
