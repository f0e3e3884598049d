"""Distinct counts from kept sketches, and profiles from file footers."""

import pytest
from pyspark.sql import functions as F

from marquee.operators import distinct_from_sketches, file_sketches
from marquee.operators.sketches import relative_error
from marquee.plans import analyses as A
from marquee.plans.build import build, land
from marquee.sources import landing, sinks
from marquee.sources.synthetic import synthetic_landing
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def built(spark):
    return build(land(synthetic_landing(spark, SF_SMALL)))


def test_estimates_stay_within_the_stated_error(spark, scratch):
    rows = spark.range(200_000).select((F.col("id") % 50_000).alias("k"), F.format_string("v%d", "id").alias("v"),
                                       F.when(F.col("id") < 0, 1).alias("none"), (F.col("id") % 3).alias("g"))
    table = sinks.as_table(rows.repartition(5), scratch + "/t")
    kept = sinks.as_table(file_sketches(table, ["k", "v", "none"]), scratch + "/s")
    assert kept.select("file").distinct().count() == 5
    got = {r["column_name"]: r["distinct_values"] for r in distinct_from_sketches(kept).collect()}
    for name, want in {"k": 50_000, "v": 200_000, "none": 0}.items():
        assert abs(got[name] - want) <= 4 * relative_error() * want
    grouped = distinct_from_sketches(file_sketches(table, ["v"], ["g"]), ["g"]).collect()
    assert len(grouped) == 3 and all(abs(r["distinct_values"] - 66_667) <= 4 * relative_error() * 66_667 for r in grouped)


def test_q01_from_sketches_reads_no_table(spark, built):
    kept = built.keep_sketches()
    got = A.q01_from_sketches(kept)
    assert all("/sketches/" in f for f in got.inputFiles())
    exact = {r["field"]: r for r in A.q01_cleaning_impact(built.catalogue).collect()}
    for r in got.collect():
        for c in ("naive_distinct_count", "true_distinct_count"):
            assert abs(r[c] - exact[r["field"]][c]) <= max(1, 4 * relative_error() * exact[r["field"]][c])


def test_profiles_from_footers_equal_the_scan(spark, built):
    path = built.root + "/raw"
    raw = sinks.open_table(spark, path)
    assert sorted(landing.stored_profile(spark, path).collect()) == sorted(landing.landing_profile(raw).collect())
    assert landing.stored_size(spark, path).collect() == landing.landing_size(raw).collect()


def test_footers_answer_without_reading_columns(spark, built):
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = own.read.parquet(sinks.current_version(spark, built.root + "/raw"))
    plan = df.agg(F.count(F.lit(1)), F.count("title"))._jdf.queryExecution().executedPlan().toString()
    assert "count(*)" in plan.lower() and "ReadSchema: struct<count(*):bigint,count(title):bigint>" in plan


def test_empty_table(spark, scratch):
    path = scratch + "/e"
    sinks.as_table(spark.createDataFrame([], "a string, b string"), path)
    assert landing.stored_size(spark, path).collect() == [(0, 2)]
    assert landing.stored_profile(spark, path).count() == 0
