"""The physical plans have the shape the design promises."""


from pyspark.sql import functions as F

from marquee.plans import analyses as A
from marquee.plans import report as R
from marquee.plans.build import build, land, run_analyses
from marquee.plans.models import Catalogue
from marquee.sources import synthetic
from marquee.sources.sinks import read_result_csv
from marquee.sources.synthetic import GENRE_LABELS, synthetic_landing
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def landed(spark):
    return land(synthetic_landing(spark, SF_SMALL))


def test_unique_build_is_narrow(spark):
    cat = Catalogue(landed(spark))
    assert cat.unique_keys
    for df in (cat.staging, cat.countries, cat.genres, cat.people, cat.mart):
        p = plan(df)
        assert "Exchange" not in p and "Join" not in p, p


def test_uniqueness_check_reads_only_the_key(spark):
    cat = Catalogue(landed(spark))
    dup = cat.staging.groupBy("show_id").count()
    p = dup._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<show_id:string>" in p or "struct<show_id:string>" in p


def test_lines_of_the_landing_are_shuffled_once(spark):
    """One exchange of numbers by order, one of the orders; packing and the
    join with the orders need no other."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10_000)
    try:
        lines = plan(synthetic_landing(spark, SF_SMALL)).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in lines if "Exchange hashpartitioning" in line]
    assert len(moved) == 2 and all("name" not in line for line in moved), lines


def test_names_of_many_suppliers_come_to_the_orders(spark, scratch, monkeypatch):
    """Suppliers beyond the session's broadcast threshold: lines are still shuffled
    once; with too many of them they are joined by a shuffle, to the same rows."""
    path = f"{scratch}/in"
    spark.sql("select id o_orderkey, id o_custkey, timestamp_ntz'1997-01-02 00:00:00' o_orderdate, '1-URGENT' o_orderpriority "
              "from range(40)").write.parquet(f"{path}/orders.parquet")
    spark.sql("select id div 5 l_orderkey, id * 3 l_partkey, id * 7 % 3000 l_suppkey, id % 5 l_linenumber "
              "from range(200)").write.parquet(f"{path}/lineitem.parquet")
    spark.sql("select id s_suppkey, concat('Supplier#', id % 2900) s_name, id % 2 s_nationkey "
              "from range(3000)").write.parquet(f"{path}/supplier.parquet")
    spark.sql("select id n_nationkey, concat('N', id) n_name from range(2)").coalesce(1).write.parquet(f"{path}/nation.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 5_000)
    try:
        landing = synthetic_landing(spark, path)
        lines = plan(landing).splitlines()
        rows = sorted(map(str, landing.collect()))
        monkeypatch.setattr(synthetic, "BROADCAST_SUPPLIERS", 100)
        by_shuffle = synthetic_landing(spark, path)
        assert "SortMergeJoin [l_suppkey" in plan(by_shuffle)
        assert sorted(map(str, by_shuffle.collect())) == rows and len(rows) == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in lines if "Exchange hashpartitioning" in line]
    assert len(moved) == 2 and all("name" not in line for line in moved), lines


def test_repeated_keys_are_rolled_up_by_one_group_by(spark):
    """The mart of a landing with repeated keys: one shuffle by title for the
    rollups, one for the rows that they join."""
    mart = Catalogue(landed(spark), unique_keys=False).mart
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        lines = plan(mart.select("*")).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("Exchange hashpartitioning" in line for line in lines) == 2, lines


def test_an_order_of_very_many_lines_is_packed(spark, scratch):
    """Equal names of an order are packed once, in order of their first lines."""
    path = scratch + "/hot"
    for t in ("orders", "supplier", "nation"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{path}/{t}.parquet")
    n = 200_000
    spark.range(n).select(
        F.lit(2).cast("bigint").alias("l_orderkey"), (F.col("id") % 84).alias("l_partkey"),
        (9 - F.col("id") % 10).alias("l_suppkey"), (n - F.col("id")).cast("int").alias("l_linenumber"),
    ).write.parquet(f"{path}/lineitem.parquet")
    row = synthetic_landing(spark, path).filter("show_id = 's2'").first()
    # The last lines come first: id n - 1 has supplier 0 and label 79 % 42.
    assert row["cast"] == ", ".join(f"Supplier#{k:09d}" for k in range(10))
    assert row["listed_in"] == ", ".join(GENRE_LABELS[(n - 1 - k) % 84 % 42] for k in range(42))


def test_bridge_mart_analyses_join_one_row_per_title(spark):
    """On a finished build they read the bridge and the mart, reduce the mart
    to one row per title and join on the title: no self-join, no pair of copies."""
    cat = build(landed(spark)).catalogue
    for fn in (A.country_credits, A.genre_tags, A.q07_top_people, A.q10_co_production):
        df = fn(cat)
        p = plan(df)
        assert "CartesianProduct" not in p and "NestedLoop" not in p, p
        assert any("/dim_title/" in f for f in df.inputFiles()) and "posexplode(split" not in p.replace(" ", ""), p


def test_shares_come_from_one_join(spark):
    """Groups and grand total are one aggregate over one bridge x mart join."""
    cat = build(landed(spark)).catalogue
    for fn in (A.country_credits, A.genre_tags):
        df = fn(cat)
        joins = [line for line in plan(df).splitlines() if "Join" in line]
        assert len(joins) == 1, joins
        got = {r["whole"]: r["titles"] for r in df.groupBy("whole").agg({"titles": "sum"}).withColumnRenamed("sum(titles)", "titles").collect()}
        assert set(got) == {0, 1} and got[0] == got[1]


def test_shares_hold_no_group_table_in_one_task(spark):
    cat = build(landed(spark)).catalogue
    for fn in (A.q04_country_production, A.q05_genre_profile):
        assert "Window" not in plan(fn(cat))


def test_orphans_are_found_without_a_join(spark):
    """One aggregate over the stacked keys: no join, one scan of the mart."""
    from marquee.plans import assertions as T
    df = T.t09_referential_integrity(build(landed(spark)).catalogue)
    p = plan(df)
    assert "Join" not in p and p.count("FileScan") == 4, p
    assert sum("/dim_title/" in f for f in df.inputFiles()) == len({f for f in df.inputFiles() if "/dim_title/" in f})


def test_approximate_variants_close(spark):
    cat = Catalogue(synthetic_landing(spark, SF_SMALL))
    exact = {r["field"]: r["true_distinct_count"] for r in A.q01_cleaning_impact(cat).collect()}
    approx = {r["field"]: r["true_distinct_count"]
              for r in A.q01_cleaning_impact(cat, approx=True).collect()}
    for k in exact:
        assert abs(exact[k] - approx[k]) <= max(2, 0.1 * exact[k])
    e = A.q06_duration_distribution(cat).orderBy("unit").collect()
    a = A.q06_duration_distribution(cat, approx=True).orderBy("unit").collect()
    for x, y in zip(e, a):
        assert x["titles"] == y["titles"] and abs(x["median_value"] - y["median_value"]) <= 2


def test_results_written_and_read_back(spark, scratch):
    wh = build(landed(spark))
    out = run_analyses(wh.catalogue, out_dir=scratch + "/results", preview_rows=5)
    assert [o["analysis"] for o in out] == sorted(A.ANALYSES)
    q07 = next(o for o in out if o["analysis"] == "07_top_people")
    assert len(q07["preview"]) == 5 and q07["rows"] > 5
    df = A.q02_completeness(wh.catalogue)
    back = read_result_csv(spark, next(o["path"] for o in out
                                      if o["analysis"] == "02_completeness"), df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_country_lookup_and_top_k(spark):
    cat = Catalogue(synthetic_landing(spark, SF_SMALL))
    top = R.r4_top_countries(cat, n=5).collect()
    assert len(top) == 5 and [r["titles"] for r in top] == sorted(r["titles"] for r in top)
    one = R.country_lookup(cat, top[-1]["country"]).collect()
    assert len(one) == 1 and one[0]["titles"] == top[-1]["titles"]
    assert R.country_lookup(cat, "Nowhere").count() == 0


def test_approximate_distinct_in_q05_q07(spark):
    cat = Catalogue(synthetic_landing(spark, SF_SMALL))
    for fn, col, key in ((A.q05_genre_profile, "countries_producing", "genre"),
                         (A.q07_top_people, "countries", "person_name")):
        exact = {r[key]: r[col] for r in fn(cat).collect()}
        approx = {r[key]: r[col] for r in fn(cat, approx=True).collect()}
        assert exact.keys() == approx.keys()
        assert all(abs(exact[k] - approx[k]) <= max(1, 0.1 * exact[k]) for k in exact)
