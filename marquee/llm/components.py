"""Connected components of an undirected graph given as rows of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (columns a, b of type bigint); label: the smallest node reachable.

    Each round moves every node to the smallest of itself and its neighbours
    and contracts the edges accordingly, until no edge is left; a star takes
    one round.  Minima are combined before they are shuffled, and joins are
    between written tables, so that a hot node's rows can be split.  Edges
    with a null end are left out; no edges give no rows.
    """
    edges, labels = edges.filter("a <> b").select("a", "b"), None
    while True:
        edges = written(edges)
        if edges.isEmpty():
            break
        both = edges.union(edges.select("b", "a"))
        step = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                       .select("node", F.least("node", "m").alias("to")))
        if labels is None:
            labels = step.select("node", F.col("to").alias("label"))
        else:
            moved = step.select(F.col("node").alias("label"), "to")
            labels = written(labels.join(moved, "label", "left").select(
                "node", F.coalesce("to", "label").alias("label")))
        first, second = step.toDF("a", "x"), step.toDF("b", "y")
        edges = (edges.join(first, "a").join(second, "b").filter("x <> y")
                 .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
