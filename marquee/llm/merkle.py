"""Merkle dataset manifest: a hash tree over the rows of each group, with proofs.

Slot pivot.  A node's place in its group, written in base ``fanout``, says
everything: its last digit is its slot below its parent, the digits before
name the parent.  Conditional aggregates over a parent's nodes spread them
into ``fanout`` columns; the columns joined and hashed are the parent, and the
columns without the node's own slot are its siblings.

1. Leaves.  Each row is hashed and numbered within its group by a two-level
   scan over range partitions, so that a group of any size is dealt evenly.
2. Tiers.  ``fanout ** LEVELS`` consecutive nodes are a block.  A block's
   levels are windows over ever shorter prefixes of the digits, all on one
   shuffle and one sort.  The blocks' tops are the nodes of the next tier;
   a tier has 1024 times fewer rows than the one below.
3. The groups' tops (subroots), numbered in order of their group, are a tree of
   their own, whose top is the root.
4. Tiers are joined from the top down: a block's path continues its nodes'.

H of a node is the lowercase hex SHA-256 of its children's digests as hex text,
left to right; a last run may have fewer children, even one.  A lone node is
the top itself.  H of a leaf takes ``LEAF_COLUMNS`` in order, each ``-`` if
null, else its UTF-8 byte count, ``:`` and the value as text.

Cases: a null group is a group of its own, which comes first; rows without an
id come first in their group, rows that share an id stand in order of their
leaf digest; repeated rows are leaves each; an empty table gives no rows; other
columns are left out, whatever their names (``carry`` takes some along).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators import positions

from .common import broadcast_if_few, written

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
#: Levels that one tier climbs: a block holds ``fanout ** LEVELS`` nodes (1024).
LEVELS = 10
PATH = "array<struct<left:string,right:string>>"


def leaf_digest(values: list[Column]) -> Column:
    """H of the values, each with its length, so that no two rows share a preimage."""
    def field(v: Column) -> Column:
        v = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return F.sha2(F.concat(*map(field, values)), 256)


def parent_digest(children: list[Column]) -> Column:
    return F.sha2(F.concat(*[F.coalesce(c, F.lit("")) for c in children]), 256)


def _climbed(nodes: DataFrame, group: str, fanout: int, levels: int) -> DataFrame:
    """One tier: ``nodes`` (group, place, nodes, node) with ``block``, ``path`` and ``top``, the block's top node.

    ``nodes`` is the group's number of nodes: a block stops where its group has
    a single node left."""
    size = fanout ** levels
    digits = [f"__d{k}" for k in range(levels)]
    rows = nodes.select(
        "*", F.floor(F.col("place") / size).cast("bigint").alias("block"), F.col("node").alias("top"),
        F.expr(f"cast(array() as {PATH})").alias("path"),
        *[F.pmod(F.floor(F.col("place") / fanout ** k), F.lit(fanout)).cast("byte").alias(d)
          for k, d in enumerate(digits)])
    # Nodes stand in order of their digits, so every window below takes a prefix of this order.
    rows = rows.repartition(group, "block").sortWithinPartitions(group, "block", *reversed(digits))
    for k, digit in enumerate(digits):
        below = Window.partitionBy(group, "block", *reversed(digits[k + 1:]))
        slots = [f"__s{j}" for j in range(fanout)]
        rows = rows.select("*", *[F.max(F.when(F.col(digit) == j, F.col("top"))).over(below).alias(s)
                                  for j, s in enumerate(slots)])
        column = [F.coalesce(F.col(s), F.lit("")) for s in slots]
        side = F.struct(
            F.concat(F.lit(""), *[F.when(F.col(digit) > j, c).otherwise("") for j, c in enumerate(column)]).alias("left"),
            F.concat(F.lit(""), *[F.when(F.col(digit) < j, c).otherwise("") for j, c in enumerate(column)]).alias("right"))
        climbs = F.col("nodes") > fanout ** k
        rows = rows.withColumns({
            "path": F.when(climbs, F.concat("path", F.array(side))).otherwise(F.col("path")),
            "top": F.when(climbs, parent_digest(column)).otherwise(F.col("top"))}).drop(*slots)
    return rows.drop(*digits)


def _tree(nodes: DataFrame, group: str, fanout: int, levels: int) -> DataFrame:
    """``nodes`` (group, place, node and others) with ``path`` up to the group's top, and that ``top``."""
    size = fanout ** levels
    counted = written(nodes.groupBy(group).agg(F.count(F.lit(1)).alias("nodes")))
    counted_few = broadcast_if_few(counted)
    met = nodes.alias("n").join(counted_few.alias("c"), F.col(f"n.`{group}`").eqNullSafe(F.col(f"c.`{group}`")))
    tier = written(_climbed(met.select("n.*", "c.nodes"), group, fanout, levels))
    tiers = [tier]
    while not tier.filter(F.col("nodes") > size).limit(1).isEmpty():
        nodes = (tier.groupBy(group, F.col("block").alias("place"))
                 .agg(F.max("top").alias("node"), F.max("nodes").alias("nodes"))
                 .withColumn("nodes", F.ceil(F.col("nodes") / size)))
        tier = written(_climbed(nodes, group, fanout, levels))
        tiers.append(tier)
    above = tiers.pop()
    while tiers:
        lower = tiers.pop().alias("l")
        upper = broadcast_if_few(above.select(group, "place", "path", "top")).alias("u")
        same = F.col(f"l.`{group}`").eqNullSafe(F.col(f"u.`{group}`")) & (F.col("l.block") == F.col("u.place"))
        above = lower.join(upper, same).select(
            *[f"l.`{c}`" for c in lower.columns if c not in ("path", "top")],
            F.concat("l.path", "u.path").alias("path"), "u.top")
        if tiers:
            above = written(above)
    return above.drop("block", "nodes")


def manifest(docs: DataFrame, group: str = "lang", doc_id: str = "doc_id", leaf_columns=LEAF_COLUMNS,
             fanout: int = FANOUT, levels: int = LEVELS, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row for each of ``docs``: id, group, ``leaf``, ``place`` in the group, ``path`` (each level's
    siblings left and right of the own slot, up to the root), ``subroot`` and ``root``.

    ``carry`` adds columns made from ``docs``; its texts themselves don't travel."""
    carry = carry or {}
    leaves = docs.select(F.col(doc_id).alias("__id"), F.col(group).cast("string").alias("__group"),
                         leaf_digest([F.col(c) for c in leaf_columns]).alias("node"),
                         *[c.alias(f"__c_{n}") for n, c in carry.items()])
    placed = positions(leaves, [F.col("__id"), F.col("node")], ["__group"], "place")
    own = _tree(placed, "__group", fanout, levels)
    # A lang's rows all hold its top; the partial maxima leave one for each task.
    tops = written(own.groupBy("__group").agg(F.max("top").alias("node"))).withColumn("__whole", F.lit(0))
    tops = positions(tops, [F.col("__whole"), F.col("__group")], None, "place")
    whole = written(_tree(tops, "__whole", fanout, levels))
    joined = own.alias("o").join(broadcast_if_few(whole).alias("w"), F.col("o.__group").eqNullSafe(F.col("w.__group")))
    return joined.select(
        F.col("o.__id").alias("doc_id"), F.col("o.__group").alias("group"), F.col("o.node").alias("leaf"), "o.place",
        F.concat("o.path", "w.path").alias("path"), F.col("o.top").alias("subroot"), F.col("w.top").alias("root"),
        *[F.col(f"o.__c_{n}").alias(n) for n in carry])


def siblings(path: Column) -> Column:
    """The siblings' digests, level by level, joined."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings make."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))
