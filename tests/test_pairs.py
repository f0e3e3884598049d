"""Co-occurrence pairs against a plain self-join, with groups of several blocks."""

import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import pairs, weighted_pairs


def joined(rows):
    a, b = rows.toDF("g", "a"), rows.toDF("g", "b")
    return a.join(b, "g").filter("a < b").groupBy("g", "a", "b").agg(F.count(F.lit(1)).alias("w"))


@pytest.mark.parametrize("block", [3, 16, 1024])
def test_pairs_equal_the_self_join(spark, block):
    rng = random.Random(block)
    rows = [(g, f"v{rng.randrange(60)}") for g in "abc" for _ in range(80)] + [("one", "x"), ("one", "x"), (None, "x"),
                                                                             (None, "y"), ("c", None), ("d", "p"), ("d", "q")]
    df = spark.createDataFrame(rows, "g string, v string")
    got = weighted_pairs(df, "g", "v", block)
    assert sorted(map(tuple, got.select("g", "a", "b", "w").collect())) == sorted(
        map(tuple, joined(df).select("g", "a", "b", "w").collect()))


@pytest.mark.parametrize("block", [3, 16, 1024])
def test_totals_over_groups_equal_the_self_join(spark, block):
    rng = random.Random(block)
    rows = [(g, f"v{rng.randrange(60)}") for g in "abc" for _ in range(80)] + [
        ("one", "x"), ("one", "x"), (None, "x"), (None, "y"), ("c", None), ("d", "p"), ("d", "q"), ("e", "q"), ("e", "p")]
    df = spark.createDataFrame(rows, "g string, v string")
    got = weighted_pairs(df, "g", "v", block, over_groups=True)
    want = joined(df).groupBy("a", "b").agg(F.sum("w").alias("w"))
    assert got.columns == ["a", "b", "w"] and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert weighted_pairs(df.limit(0), "g", "v", block, over_groups=True).count() == 0


def test_totals_over_groups_shuffle_no_pairs(spark):
    """The shuffles hold values and lists of them; pairs are made behind the last one."""
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), (F.col("id") % 500).alias("v"))
    got = weighted_pairs(df, "g", "v", 32, over_groups=True)
    lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
    moved = [line for line in lines if "Exchange hashpartitioning" in line]
    assert moved and not any("a#" in line.split("hashpartitioning")[1] for line in moved), lines
    assert got.count() == 500 * 499 // 2


def test_totals_over_few_groups_shuffle_each_value_once(spark):
    """Blocks meet in a product of the whole tables: below it no value is repeated, above it nothing is shuffled or held."""
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), (F.col("id") % 500).alias("v"))
    got = weighted_pairs(df, "g", "v", 8, over_groups=True)
    above, below = got._jdf.queryExecution().executedPlan().toString().split("CartesianProduct")
    assert "Generate" in above and "Exchange" not in above and "Aggregate" not in above and "Generate" not in below


def test_totals_over_few_groups_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(pairs, "PAIRS_STREAMED", 700)
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") % 130).alias("v"))
    got = weighted_pairs(df, "g", "v", 8, over_groups=True)
    want = joined(df).groupBy("a", "b").agg(F.sum("w").alias("w"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("groups", [2, 16, 17, 40])
def test_totals_of_values_in_some_of_the_groups(spark, groups):
    """Sets of groups that overlap, hold one another or share nothing; more groups than stand side by side."""
    rng = random.Random(groups)
    held = {v: rng.sample(range(groups), rng.randrange(1, min(groups, 4) + 1)) for v in range(70)}
    rows = [(g, v) for v, of in held.items() for g in of for _ in range(rng.randrange(1, 4))]
    df = spark.createDataFrame([*rows, *((g, 100 + g) for g in range(groups)), (None, 1), (0, None)], "g int, v bigint")
    got = weighted_pairs(df, "g", "v", 4, over_groups=True)
    want = joined(df).groupBy("a", "b").agg(F.sum("w").alias("w"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_group_of_twenty_thousand_values(spark):
    """All pairs of one group, from many lists of at most about two blocks."""
    n = 20_000
    df = spark.range(n).select(F.lit("t").alias("g"), F.format_string("c%06d", "id").alias("v"))
    got = weighted_pairs(df, "g", "v", 2048).agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("w").alias("w"), F.count_if(F.col("a") >= F.col("b")).alias("bad"),
        F.sum(F.crc32(F.col("a").cast("binary")) % 1000).alias("s")).first()
    # Value k is the smaller one of n - 1 - k pairs.
    want = df.select(((F.crc32(F.col("v").cast("binary")) % 1000) * (n - 1 - F.substring("v", 2, 6).cast("bigint"))).alias("s"))
    assert tuple(got) == (n * (n - 1) // 2, n * (n - 1) // 2, 0, want.agg(F.sum("s")).first()[0])


def test_no_pairs(spark):
    assert weighted_pairs(spark.createDataFrame([], "g string, v string"), "g", "v").count() == 0
