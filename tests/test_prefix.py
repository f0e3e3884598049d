"""Running totals and positions over range partitions, against one plain window."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.operators import positions, running_total_by_range


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    return spark.createDataFrame(
        [(rng.choice(["a", "b", None]), rng.choice([None, *range(300)]), rng.choice([None, 1, 2, 3]))
         for _ in range(2000)] + [("hot", 7, 1)] * 1000, "g string, k int, v bigint")


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_running_total_equals_the_window(rows, groups):
    w = Window.partitionBy(*groups).orderBy("k")
    want = rows.withColumn("total", F.sum("v").over(w))
    got = running_total_by_range(rows, ["k"], "v", "total", groups)
    assert got.schema["total"].dataType == want.schema["total"].dataType
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_positions_count_each_group_in_order(rows, groups):
    seen = defaultdict(list)
    for r in positions(rows, [F.col("k").asc_nulls_first()], groups).collect():
        seen[r["g"] if groups else None].append((r["position"], (r["k"] is not None, r["k"])))
    for own in seen.values():
        own.sort()
        assert [p for p, _ in own] == list(range(len(own)))
        assert [k for _, k in own] == sorted(k for _, k in own)


def test_no_task_holds_all_rows(spark, rows):
    """No exchange to a single partition, but for one-row frames."""
    plan = running_total_by_range(rows, ["k"], "v", "total")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_empty_tables(rows):
    assert positions(rows.limit(0), [F.col("k")], ["g"]).count() == 0
    assert running_total_by_range(rows.limit(0), ["k"], "v", "total").count() == 0
