"""Prefix sums and positions over many rows: a two-level scan over range partitions.

An ordinary window without a partition key runs in one task.  Here rows are
dealt to range partitions of the order keys (equal keys stay together), each
partition is scanned on its own, and every partition then adds the total of
those before it.  Only one number for each partition (and group) is needed to
join the parts, so no task sees more than its own range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import workspace_dir
from marquee.sources.sinks import as_table

#: Low bits of ``monotonically_increasing_id`` that number the rows of a partition.
_ROW_BITS = 33
#: Offsets of up to so many (group, partition) rows are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 100_000


def _dealt(df: DataFrame, keys: list[Column], **extra: Column) -> DataFrame:
    """``df`` dealt by ranges of ``keys``, each partition in order and numbered (``_part``), written.

    Writing fixes the deal: Spark samples the ranges anew whenever the plan is
    run again, so a partition's total and its rows must come from one run."""
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = rows.select("*", F.spark_partition_id().alias("_part"), *[c.alias(n) for n, c in extra.items()])
    return as_table(rows, workspace_dir(df.sparkSession) + "/dealt")


def _offsets(totals: DataFrame, groups: list[str], value: str) -> DataFrame:
    """``groups, _part, _before``: the sum of ``value`` over the group's earlier partitions.

    Without groups there is one total for each partition, which the driver
    adds up; with groups it is a window for each group."""
    if groups:
        w = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        out = totals.withColumn("_before", F.sum(value).over(w)).drop(value)
        out = as_table(out, workspace_dir(totals.sparkSession) + "/offsets")
        return F.broadcast(out) if out.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else out
    kind = totals.schema[value].dataType.simpleString()
    before, rows = None, []
    for part, total in sorted((r["_part"], r[value]) for r in totals.select("_part", value).collect()):
        rows.append((part, before))
        before = total if before is None else before if total is None else before + total
    return F.broadcast(totals.sparkSession.createDataFrame(rows, f"_part int, _before {kind}"))


def _joined(rows: DataFrame, offsets: DataFrame, groups: list[str]) -> DataFrame:
    same = F.col("r._part") == F.col("o._part")
    for g in groups:
        same = same & F.col(f"r.`{g}`").eqNullSafe(F.col(f"o.`{g}`"))
    return rows.alias("r").join(offsets.alias("o"), same, "left").select("r.*", "o._before")


def running_total_by_range(df: DataFrame, order_by: list[str], value: str, out: str,
                           groups: list[str] | None = None) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY groups ORDER BY order_by)`` for any number of rows.

    The default RANGE frame: rows of equal order keys share their value.  NULL
    values count as nothing (NULL until the first value); NULL keys come
    first and are equal; an empty table gives none.  A key with a very
    large share of the rows stays in one partition (its rows are peers, so
    they carry the same total), where Spark's window spills to disk.
    """
    groups = groups or []
    rows = _dealt(df, [F.col(c) for c in [*groups, *order_by]])
    local = Window.partitionBy("_part", *groups).orderBy(*order_by).rangeBetween(Window.unboundedPreceding,
                                                                               Window.currentRow)
    own = rows.withColumn("_own", F.sum(value).over(local))
    totals = rows.groupBy("_part", *groups).agg(F.sum(value).alias("_total"))
    kind = own.schema["_own"].dataType
    met = _joined(own, _offsets(totals, groups, "_total"), groups)
    total = F.when(F.col("_own").isNull(), F.col("_before")).otherwise(
        F.col("_own") + F.coalesce(F.col("_before"), F.lit(0))).cast(kind)
    return met.withColumn(out, total).drop("_part", "_own", "_before")


def positions(df: DataFrame, order_by: list[Column], groups: list[str] | None = None,
              out: str = "position") -> DataFrame:
    """Each row's place (from 0) within its group in the given order, as ``ROW_NUMBER() - 1``.

    Rows of equal keys stand in any order.  One shuffle: within a partition a
    row's place is its number there less that of its group's first row.
    ``order_by`` names columns of ``df``.
    """
    groups = groups or []
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    rows = _dealt(df, [*[F.col(g) for g in groups], *order_by], _row=row)
    parts = rows.groupBy("_part", *groups).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    parts = as_table(parts, workspace_dir(df.sparkSession) + "/parts")
    before = _offsets(parts.drop("_first"), groups, "_rows")
    start = _joined(parts, before, groups).select(
        "_part", *groups, (F.coalesce("_before", F.lit(0)) - F.col("_first")).alias("_before"))
    few = parts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    met = _joined(rows, F.broadcast(start) if few else start, groups)
    return met.withColumn(out, F.col("_row") + F.col("_before")).drop("_part", "_row", "_before")
