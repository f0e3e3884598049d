"""Shares of a total and running totals over already-aggregated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import round_half_away


def share_of_total(grouped: DataFrame, total: DataFrame, count_col: str, out: str,
                   n: int = 2) -> DataFrame:
    """``ROUND(100.0 * c / total, n)``; ``total`` is a one-row frame with one
    column, computed apart from the groups, so no task holds all of them."""
    name = total.columns[0]
    return (grouped.crossJoin(F.broadcast(total.withColumnRenamed(name, "_total")))
            .withColumn(out, round_half_away(F.lit(100.0) * F.col(count_col) / F.col("_total"), n))
            .drop("_total"))


def share_within(grouped: DataFrame, part_col: str, count_col: str, out: str,
                 n: int = 1) -> DataFrame:
    """``ROUND(100.0 * c / SUM(c) OVER (PARTITION BY part), n)`` on grouped
    rows (one row per group, so the window's shuffle is small)."""
    w = Window.partitionBy(part_col)
    return grouped.withColumn(
        out, round_half_away(F.lit(100.0) * F.col(count_col) / F.sum(count_col).over(w), n))


def running_total(grouped: DataFrame, order_col: str, value_col: str, out: str) -> DataFrame:
    """``SUM(v) OVER (ORDER BY k)`` with the default RANGE frame (peers of
    equal k share the value).  Runs on one partition, which is fine because
    the input is one row per group key (here: per year)."""
    w = Window.orderBy(order_col).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return grouped.withColumn(out, F.sum(value_col).over(w).cast("bigint"))
