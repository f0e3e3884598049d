"""One-pass column profiles returned as long (name, value) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_counts(wide: DataFrame, names: list[str], name_col: str, value_col: str) -> DataFrame:
    """One-row wide counts -> (name, count) rows, in the given order."""
    return wide.unpivot([], names, name_col, value_col)


def null_profile(df: DataFrame, columns: list[str] | None = None,
                 keep_zero: bool = False) -> DataFrame:
    """NULL count of every column in a single scan (one partial aggregate per
    task, one row to the driver-side final), as (column_name, null_rows)."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    long = unpivot_counts(wide, cols, "column_name", "null_rows")
    return long if keep_zero else long.filter(F.col("null_rows") > 0)


def count_if_all(df: DataFrame, preds: dict[str, Column]) -> DataFrame:
    """Counts of several predicates in one scan, as (name, n) rows."""
    wide = df.agg(*[F.count_if(p).alias(n) for n, p in preds.items()])
    return unpivot_counts(wide, list(preds), "column_name", "null_rows")
