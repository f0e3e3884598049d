"""Create-or-replace of written tables: whole or not at all, also while it is read."""

import pytest
from pyspark.sql import functions as F

from marquee.sources import sinks


def test_replaced_while_read_and_from_itself(spark, scratch):
    path = scratch + "/t"
    old = sinks.as_table(spark.range(10), path)
    new = sinks.as_table(old.filter("id < 4"), path)
    assert (old.count(), new.count(), sinks.open_table(spark, path).count()) == (10, 4, 4)


def test_a_failed_write_leaves_the_old_table(spark, scratch):
    path = scratch + "/t"
    sinks.as_table(spark.range(5), path)
    broken = spark.range(100).select(F.raise_error(F.concat(F.lit("no "), F.col("id"))).alias("id"))
    with pytest.raises(Exception, match="no "):
        sinks.as_table(broken, path)
    assert sinks.open_table(spark, path).count() == 5


def test_schema_may_change(spark, scratch):
    path = scratch + "/t"
    sinks.as_table(spark.range(5), path)
    sinks.as_table(spark.range(3).select(F.lit("x").alias("name")), path)
    assert sinks.open_table(spark, path).columns == ["name"]


def test_old_versions_are_dropped_on_request(spark, scratch):
    path = scratch + "/t"
    for n in (1, 2, 3, 4):
        last = sinks.as_table(spark.range(n), path)
    assert len(sinks.drop_old_versions(spark, path)) == 2 and sinks.drop_old_versions(spark, path) == []
    assert len(sinks.drop_old_versions(spark, path, keep=1)) == 1
    assert last.count() == 4 and sinks.open_table(spark, path).count() == 4
    with pytest.raises(ValueError):
        sinks.drop_old_versions(spark, path, keep=0)


def test_a_build_is_found_by_name_in_a_new_session(spark):
    from marquee.plans.build import Warehouse, build, land
    from marquee.sources.synthetic import synthetic_landing
    from tests.conftest import SF_SMALL
    wh = build(land(synthetic_landing(spark, SF_SMALL)))
    other = spark.newSession()
    Warehouse.open(other, wh.root)
    for name, df in wh.models.items():
        assert other.sql(f"SELECT count(*) AS n FROM {name}").first()["n"] == df.count()


def test_ordered_result_comes_back_without_a_sort(spark, scratch):
    rows = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("n"), F.when(F.col("id") % 3 > 0, "hot").alias("k"))
    path = sinks.write_ordered_csv(rows, scratch + "/ordered", [F.desc("k"), F.desc("n")], parts=8)
    back = sinks.read_ordered_csv(spark, path, rows.schema)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    assert back.collect() == rows.orderBy(F.desc("k"), F.desc("n")).collect()
    # A file of several splits keeps its order, too.
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert [r["n"] for r in sinks.read_ordered_csv(spark, path, rows.schema).collect()] == [r["n"] for r in back.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ties_are_spread_and_the_list_is_replaced(spark, scratch):
    rows = spark.range(4_000).select(F.lit("hot").alias("k"), "id")
    path = sinks.write_ordered_csv(rows, scratch + "/ties", ["k"], parts=4)
    back = sinks.read_ordered_csv(spark, path, rows.schema)
    each = [r["count"] for r in back.groupBy(F.spark_partition_id()).count().collect()]
    assert len(each) == 4 and max(each) < 2_000
    sinks.write_ordered_csv(rows.filter("id < 3"), path, ["id"], parts=4)
    assert [r["id"] for r in sinks.read_ordered_csv(spark, path, rows.schema).collect()] == [0, 1, 2]
    assert back.count() == 4_000  # an earlier reader goes on
    sinks.write_ordered_csv(rows.limit(0), path, ["id"])
    assert sinks.read_ordered_csv(spark, path, rows.schema).count() == 0
