"""Exact quantiles of any number of distinct values, by refining histogram bins.

``percentile`` keeps a map of all distinct values, which is right for small
domains only.  Here every wanted rank has an interval of values that holds it.
A pass deals an interval's values to ``bins`` sub-bins, counts them and notes
each sub-bin's least and greatest value; the sub-bin with the rank is the next
interval.  The first pass has a bin for each sign and power of two, so even
values of very different sizes are told apart at once; the next ones cut
evenly.  Since a bin's own extremes bound it, each pass parts at least the
least from the greatest value, and an interval of equal values is done.

A task holds ``bins`` counters for each open interval, whatever the number of
rows; the driver only sees how many ranks are open.  Intervals are narrowed
in Spark, so there may be very many groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import workspace_dir
from marquee.sources.sinks import as_table

BINS = 1024
#: Open intervals of up to so many rows are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 100_000


def _kept(df: DataFrame, name: str) -> DataFrame:
    return as_table(df, workspace_dir(df.sparkSession) + "/" + name)


def _size_bin(v: Column) -> Column:
    """A number that never falls as the value grows: its sign and power of two; zero, infinities and NaN apart."""
    power = F.floor(F.log2(F.abs(v))).cast("int") + 1100  # 26 at the least power of a double, 2124 at the largest
    return (F.when(F.isnan(v), F.lit(4000)).when(v == float("inf"), F.lit(3000)).when(v == float("-inf"), F.lit(-3000))
            .when(v == 0, F.lit(0)).when(v > 0, power).otherwise(-power))


def _even_bin(v: Column, low: Column, high: Column, bins: int) -> Column:
    return F.least(F.floor((v - low) / (high - low) * bins).cast("int"), F.lit(bins - 1))


def exact_quantiles(df: DataFrame, value: str, probabilities: list[float], groups: list[str] | None = None,
                    out: str = "quantiles", bins: int = BINS, from_low: bool = False) -> DataFrame:
    """One row per group (one row in all without groups) with ``out``, an array of the values at ``probabilities``.

    Continuous quantiles with linear interpolation, as ``percentile``.  NULL
    values are ignored: a group without any other value, and an empty table,
    have no row.  NaN counts as the greatest value.  Values are compared as
    doubles.  ``from_low`` interpolates as the reference engine does, low +
    share * (high - low): the last bits may differ from ``percentile``."""
    groups = groups or []
    # Without groups there is one group of everything, which an empty table doesn't have.
    own = [F.col(g) for g in groups] or [F.lit(0)]
    keys = [f"_g{k}" for k in range(len(own))]
    rows = df.select(*[g.alias(k) for g, k in zip(own, keys, strict=True)], F.col(value).cast("double").alias("_v"))
    rows = _kept(rows.filter(F.col("_v").isNotNull()), "values")
    first = _kept(rows.groupBy(*keys, _size_bin(F.col("_v")).alias("_bin")).agg(*_cell()).drop("_bin"), "cells")
    counts = first.groupBy(*keys).agg(F.sum("_n").alias("_all"))
    # The values at the whole places around each probability are wanted.
    place = F.col("_p") * (F.col("_all") - 1)
    wanted = counts.withColumn("_p", F.explode(F.array(*[F.lit(float(p)) for p in sorted(set(probabilities))]))).select(
        *keys, "_p", place.alias("_place"),
        F.explode(F.array_distinct(F.array(F.floor(place).cast("bigint"), F.ceil(place).cast("bigint")))).alias("_rank"))
    wanted = _kept(wanted, "wanted")
    ranks = wanted.select(*keys, "_rank", F.col("_rank").alias("_left")).distinct()
    open_, found = _kept(_narrowed(_joined(ranks, first, keys), keys), "intervals"), []
    while True:
        found.append(open_.filter("_low <=> _high").select(*keys, "_rank", F.col("_low").alias("_found")))
        open_ = open_.filter("not (_low <=> _high)")
        if open_.isEmpty():
            break
        spans = open_.select(*keys, "_low", "_high").distinct()
        inside = _joined(rows, spans, keys, F.col("l._v").between(F.col("r._low"), F.col("r._high")))
        binned = inside.groupBy(*keys, "_low", "_high", _even_bin(F.col("_v"), F.col("_low"), F.col("_high"), bins).alias("_bin"))
        cells = _kept(binned.agg(*_cell()).drop("_bin"), "cells")
        here = _joined(open_.select(*keys, "_rank", "_left", "_low", "_high"), cells, keys,
                       (F.col("l._low") == F.col("r._low")) & (F.col("l._high") == F.col("r._high")), ("_low", "_high"))
        open_ = _kept(_narrowed(here, keys), "intervals")
    values = found[0]
    for more in found[1:]:
        values = values.union(more)
    met = _joined(wanted, values, keys, F.col("l._rank") == F.col("r._rank"), ("_rank",))
    # Interpolated as `percentile` does: the farther place weighs less.
    low, high = F.min("_rank"), F.max("_rank")
    at = F.first("_place")
    least, most = F.min("_found"), F.max("_found")
    value_at = F.when((low == high) | least.eqNullSafe(most), least)
    if from_low:  # where the difference is a finite number
        value_at = value_at.when(most - least < float("inf"), least + (at - low) * (most - least))
    value_at = value_at.otherwise((high - at) * least + (at - low) * most)
    each = met.groupBy(*keys, "_p").agg(value_at.alias("_q"))
    listed = each.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_p", "_q"))).alias("_m"))
    picked = F.array(*[F.element_at("_m", F.lit(float(p))) for p in probabilities])
    return listed.select(*[F.col(k).alias(g) for g, k in zip(groups, keys, strict=False)], picked.alias(out))


def _cell() -> list[Column]:
    return [F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")]


def _joined(left: DataFrame, right: DataFrame, keys: list[str], more: Column | None = None,
            drop: tuple = ()) -> DataFrame:
    """``left`` with the columns of ``right`` where the groups (nulls are a group) and ``more`` hold."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    same = same if more is None else same & more
    rest = [c for c in right.columns if c not in (*keys, *drop)]
    few = right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return left.alias("l").join((F.broadcast(right) if few else right).alias("r"), same).select(
        "l.*", *[f"r.{c}" for c in rest])


def _narrowed(cells: DataFrame, keys: list[str]) -> DataFrame:
    """For each rank the cell that holds it: ``_left`` counts on from the cell's first value."""
    before = F.sum("_n").over(Window.partitionBy(*keys, "_rank").orderBy("_least")
                              .rowsBetween(Window.unboundedPreceding, -1))
    at = cells.withColumn("_before", F.coalesce(before, F.lit(0)))
    return at.filter((F.col("_left") >= F.col("_before")) & (F.col("_left") < F.col("_before") + F.col("_n"))).select(
        *keys, "_rank", (F.col("_left") - F.col("_before")).alias("_left"), F.col("_least").alias("_low"),
        F.col("_most").alias("_high"))
