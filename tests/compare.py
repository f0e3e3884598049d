"""Order-insensitive comparison of a Spark result with DuckDB SQL."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        return _norm(v.item())
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        if isinstance(v, float) and math.isnan(v):
            return None
        return round(float(v), 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, sql: str, sf_dir: str) -> tuple[bool, str]:
    left = spark_df.toPandas()
    right = duck(sf_dir).execute(sql).fetchdf()
    if sorted(left.columns) != sorted(right.columns):
        return False, f"columns differ: {sorted(left.columns)} vs {sorted(right.columns)}"
    if len(left) != len(right):
        return False, f"row count differs: spark {len(left)} vs duckdb {len(right)}"
    a, b = rows_of(left), rows_of(right)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return False, f"first difference at sorted row {i}:\n spark  {x}\n duckdb {y}"
    return True, f"{len(a)} rows equal"
