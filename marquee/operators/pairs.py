"""Unordered co-occurrence pairs inside a group, streamed as rows."""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import workspace_dir
from marquee.sources.sinks import as_table

#: Distinct values that stand in one list; a group with more is dealt into blocks of about so many.
BLOCK = 1024
#: Pairs that a task sums over the groups; their totals fit its memory.
PAIRS_IN_TASK = 4_000_000
#: Up to so many groups a value's multiplicities stand side by side, and a pair's total needs no memory.
FEW_GROUPS = 16
#: Pairs that a task makes where it holds none of them.
PAIRS_STREAMED = 16_000_000
#: Most values of a block there: the pairs of two blocks are made in one go and stand in memory until they are read.
STREAMED_BLOCK = 256


def _later(values: Column, i: Column) -> Column:
    return F.slice(values, i + 2, F.size(values))


def _counted(rows: DataFrame, group: str, value: str) -> DataFrame:
    return rows.filter(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(
        group, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("m"))


def _pairs(lists: DataFrame, *keep: str) -> DataFrame:
    """The pairs of each row's ``left`` with its ``right``; a block that meets itself (``_i = _j``) with
    each value's later ones."""
    first = lists.select(*keep, "left", "right", F.expr("_i = _j").alias("same"), F.posexplode("left").alias("i", "x"))
    partners = F.when(F.col("same"), _later(F.col("left"), F.col("i"))).otherwise(F.col("right"))
    pairs = first.select(*keep, "x", F.explode(partners).alias("y"))
    return pairs.select(*keep, F.least("x.v", "y.v").alias("a"), F.greatest("x.v", "y.v").alias("b"),
                        (F.col("x.m") * F.col("y.m")).alias("w"))


def weighted_pairs(rows: DataFrame, group: str, value: str, block: int = BLOCK, over_groups: bool = False) -> DataFrame:
    """Rows ``group, a, b, w``: the pairs a < b of a group's distinct values,
    each weighted by the product of their multiplicities.

    This equals the pair count of a self-join of ``rows`` on ``group`` with
    ``a < b``.  Multiplicities are counted first (map-side combined).  A group
    of n distinct values has ceil(n / block) blocks, to which its values are
    dealt by hash; every two blocks (and every block with itself) meet in a
    list of their own, so a very large group is spread over many tasks and no
    list holds more than about two blocks.  A value travels once for each
    block of its group: once only in the groups of up to ``block`` values.
    Pairs stream as rows through two generators; no quadratic array is built.

    NULL values pair with nothing; rows with a NULL group form no pairs.

    ``over_groups`` gives rows ``a, b, w`` instead, each pair's weights summed
    over all groups, for groups so large that their pairs could not be shuffled.
    Over up to ``FEW_GROUPS`` groups only the values are, each once; over more
    a value travels as above.
    """
    if over_groups:
        return _pair_totals(rows, group, value, block)
    counted = _counted(rows, group, value)
    sizes = counted.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(
        group, F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("v"), "_blocks").cast("int")
    dealt = counted.join(sizes, group).withColumn("_own", own).select(
        group, "v", "m", "_own", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
    # Dealt by block pair: the join's partitioning by group would keep a large group's lists in one task.
    meeting = dealt.select(group, "v", "m", "_own", "_other", F.least("_own", "_other").alias("_i"),
                           F.greatest("_own", "_other").alias("_j")).repartition(group, "_i", "_j").groupBy(group, "_i", "_j")
    side = F.struct("v", "m")
    lists = meeting.agg(F.array_sort(F.collect_list(F.when(F.col("_own") <= F.col("_other"), side))).alias("left"),
                        F.array_sort(F.collect_list(F.when(F.col("_own") > F.col("_other"), side))).alias("right"))
    return _pairs(lists, group)


def _pair_totals(rows: DataFrame, group: str, value: str, block: int) -> DataFrame:
    """Each pair's total weight over all groups; no pair is shuffled."""
    counted = as_table(_counted(rows, group, value), workspace_dir(rows.sparkSession) + "/counted")
    marks = [r["mark"] for r in counted.select(group, F.xxhash64(group).alias("mark")).distinct().limit(FEW_GROUPS + 1).select(
        "mark").collect()]
    if marks and len(set(marks)) == len(marks) <= FEW_GROUPS:
        return _totals_side_by_side(counted, group, sorted(marks), min(block, STREAMED_BLOCK))
    return _totals_by_lists(counted, group, block)


def _totals_side_by_side(counted: DataFrame, group: str, marks: list[int], block: int) -> DataFrame:
    """The totals over few groups (told by their hashes): a value's row has its multiplicity in each.

    A pair is summed as it is made, so no totals are held.  Values of the same
    set of groups stand in blocks together, and two blocks meet where they
    share a group: each of their pairs counts.  The blocks are dealt to
    partitions, and every two partitions meet in a task that reads them both;
    only the blocks themselves are shuffled, once."""
    each = [f"_m{k}" for k in range(len(marks))]
    wide = counted.groupBy("v").agg(*[F.sum(F.when(F.xxhash64(group) == mark, F.col("m")).otherwise(0)).alias(name)
                                      for mark, name in zip(marks, each, strict=True)])
    held = sum((F.when(F.col(name) > 0, 1 << k).otherwise(0) for k, name in enumerate(each)), F.lit(0)).alias("_held")
    wide = as_table(wide.select("v", *each, held), workspace_dir(counted.sparkSession) + "/wide")
    values = wide.count()
    parts = max(2, math.ceil((values * (values - 1) / 2 / PAIRS_STREAMED) ** 0.5))
    sizes = wide.groupBy("_held").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("v"), "_blocks").cast("int").alias("_own")
    lists = wide.join(sizes, "_held").groupBy("_held", own).agg(F.array_sort(F.collect_list(F.struct("v", *each))).alias("_list"))
    # Dealt in turn: every task gets as many blocks, and the number of tasks is the square of this one.
    lists = lists.select("_held", (F.shiftleft(F.col("_held").cast("bigint"), 32) + F.col("_own")).alias("_no"),
                         "_list").repartition(parts)
    left, right = lists.alias("l").hint("shuffle_replicate_nl"), lists.alias("r")
    met = left.join(right, (F.col("l._no") <= F.col("r._no")) & (F.col("l._held").bitwiseAND(F.col("r._held")) != 0)).select(
        F.col("l._list").alias("_left"), F.col("r._list").alias("_right"), (F.col("l._no") == F.col("r._no")).alias("_same"))
    first = met.select("_right", "_same", F.posexplode("_left").alias("_i", "x"))
    both = first.select("_same", "_i", "x", F.posexplode("_right").alias("_j", "y")).filter("not _same or _i < _j")
    total = functools.reduce(operator.add, [F.col(f"x.{name}") * F.col(f"y.{name}") for name in each])
    return both.select(F.least("x.v", "y.v").alias("a"), F.greatest("x.v", "y.v").alias("b"), total.alias("w"))


def _totals_by_lists(counted: DataFrame, group: str, block: int) -> DataFrame:
    """The totals over any number of groups.

    A value has the same block in every group, so a pair is found where its
    two blocks meet, whatever the group, and is summed there.  Lists of about
    ``block`` values travel, once for each block of their group (a group of
    few values has few)."""
    blocks = max(1, -(-counted.agg(F.count_distinct("v").alias("n")).first()["n"] // block))
    own = F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int").alias("_own")
    held = counted.groupBy(group, own).agg(F.array_sort(F.collect_list(F.struct("v", "m"))).alias("side"))
    met = counted.groupBy(group).agg(F.collect_set(own).alias("_blocks"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    pairs = met.agg(F.sum(F.expr("double(_n) * (_n - 1) / 2")).alias("n")).first()["n"] or 0
    tasks = int(pairs // PAIRS_IN_TASK) + int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Few rows that become many: dealt before they are multiplied, whatever the partitions of the join.
    dealt = held.join(met.drop("_n"), group).repartition(min(tasks, 1000), group, "_own").select(
        group, "side", "_own", F.explode("_blocks").alias("_other"))
    meeting = dealt.withColumns({"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")}).repartition(
        tasks, "_i", "_j").groupBy("_i", "_j", group)
    lists = meeting.agg(F.first(F.when(F.col("_own") == F.col("_i"), F.col("side")), True).alias("left"),
                        F.first(F.when(F.col("_own") > F.col("_i"), F.col("side")), True).alias("right"))
    # Partitioned by block pair already: the totals need no other shuffle.
    return _pairs(lists, "_i", "_j").groupBy("_i", "_j", "a", "b").agg(F.sum("w").alias("w")).drop("_i", "_j")
