"""Plan-level properties: both model plans agree with the oracle, the build
reads back what it wrote, a finished build opens again, the suite reports."""

import pytest
from pyspark.sql import functions as F

from marquee import oracle as O
from marquee.plans import analyses as A
from marquee.plans import assertions as T
from marquee.plans.build import Warehouse, build, land, run
from marquee.plans.models import Catalogue
from marquee.sources.landing import require_inputs
from marquee.sources.synthetic import synthetic_landing
from tests.compare import compare
from tests.conftest import SF_SMALL

ANALYSIS_KEYS = {k: "q" + k for k in A.ANALYSES}
ANALYSIS_KEYS["10_co_production_network"] = "q10_co_production"


@pytest.mark.parametrize("name", sorted(A.ANALYSES))
def test_grouped_plan_equals_oracle_on_unique_keys(spark, name):
    """Force the non-unique (grouped) plan on clean data: same answers."""
    cat = Catalogue(synthetic_landing(spark, SF_SMALL), unique_keys=False)
    ok, msg = compare(A.ANALYSES[name](cat), O.with_models(O.ANALYSIS_SQL[ANALYSIS_KEYS[name]]),
                      SF_SMALL)
    assert ok, msg


def test_hot_key_many_copies(spark):
    """One key holding many copies: exact weighted results on the plain plan."""
    raw = synthetic_landing(spark, SF_SMALL)
    hot = raw.filter(F.col("show_id") == "s4")
    many = raw.unionByName(hot.crossJoin(spark.range(300)).drop("id"))
    cat = Catalogue(many)
    assert cat.unique_keys is False
    m = cat.mart.filter(F.col("show_id") == "s4")
    assert m.count() == 301
    cc = m.select("country_count").distinct().first()[0]
    own = Catalogue(hot).mart.first()["country_count"]
    assert cc == own * 301
    assert cat.countries.filter(F.col("show_id") == "s4").count() == own * 301
    # Pair counts scale with copies squared times mart rows, without
    # materialising those pairs.
    q10 = A.q10_co_production(cat, min_pairs=1)
    base = A.q10_co_production(Catalogue(hot), min_pairs=1).collect()
    got = {(r["country_a"], r["country_b"]): r["co_productions"] for r in q10.collect()}
    for r in base:
        assert got[(r["country_a"], r["country_b"])] >= r["co_productions"] * 301 ** 3


def test_both_key_plans_write_one_schema(spark):
    raw = synthetic_landing(spark, SF_SMALL)
    narrow, grouped = Catalogue(raw, unique_keys=True), Catalogue(raw, unique_keys=False)
    for model in ("countries", "genres", "people", "mart"):
        a, b = getattr(narrow, model), getattr(grouped, model)
        assert [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]


def test_pairs_of_a_title_with_many_countries(spark):
    rows = spark.range(2000).select(F.lit("s1").alias("show_id"), F.concat(F.lit("c"), F.lpad("id", 5, "0")).alias("country"))
    from marquee.operators import weighted_pairs
    pairs = weighted_pairs(rows, "show_id", "country")
    assert pairs.count() == 2000 * 1999 // 2
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan.lower() or plan.lower().count("transform(") == 0


def test_build_reads_back_and_matches(spark):
    raw = land(synthetic_landing(spark, SF_SMALL))
    wh = build(raw)
    names = [b.model for b in wh.report]
    assert names[0] == "stg_titles" and names[-1] == "dim_title"
    assert {b.model: b.rows for b in wh.report}["dim_title"] == 1500
    ok, msg = compare(A.q04_country_production(wh.catalogue),
                      O.with_models(O.ANALYSIS_SQL["q04_country_production"]), SF_SMALL)
    assert ok, msg
    assert "int_title_countries" in wh.catalogue.countries.inputFiles()[0]
    assert wh.total()[0] == sum(b.rows for b in wh.report) and wh.total()[1] > 0


def test_a_finished_build_opens_in_another_session(spark, scratch):
    root = build(land(synthetic_landing(spark, SF_SMALL, ("bad_type",)), scratch + "/wh")).root
    other = Warehouse.open(spark.newSession(), root)
    assert other.models["dim_title"].count() == 1500
    _, results = run(mode="test", root=root, max_year=2027, stop_on_failure=False, spark=spark.newSession())
    assert [r.name for r in results if r.status != "pass"] == ["accepted_values_type"]
    with pytest.raises(T.AssertionsFailed):
        run(mode="test", root=root, max_year=2027, spark=spark)
    with pytest.raises(FileNotFoundError):
        Warehouse.open(spark, scratch + "/nothing")


def test_default_latest_year_is_the_next_one(spark):
    import datetime
    year = datetime.date.today().year
    raw = synthetic_landing(spark, SF_SMALL).limit(2)
    cat = Catalogue(raw.withColumn("release_year", F.when(F.col("show_id") == raw.first()["show_id"], F.lit(str(year + 1)))
                                   .otherwise(F.lit(str(year + 2)))))
    assert [r["release_year"] for r in T.t10_release_year_plausible(cat).collect()] == [year + 2]


def test_thresholds_drop_rows(spark):
    from marquee.plans import report as R
    cat = build(land(synthetic_landing(spark, "/root/testdata/sf0.01"))).catalogue
    assert A.q07_top_people(cat, min_credits=1).count() > A.q07_top_people(cat).count() > 0
    assert A.q10_co_production(cat, min_pairs=1).count() > A.q10_co_production(cat).count() > 0
    assert cat.mart.filter(F.col("seasons") > R.MAX_SEASONS_SHOWN).count() > 0
    last = R.HIST_START + R.HIST_STEP * R.HIST_BINS
    assert cat.mart.filter(F.col("duration_minutes") > last).count() > 0
    assert cat.mart.filter(F.col("genre_count") > 3).count() > 0


def test_labels_normalise_to_the_known_names(spark):
    from marquee.functions import normalise_genre
    # The 29 names of the published genre profile.
    known = """Action & Adventure|Anime Features|Anime Series|British TV Shows|Classic & Cult|Comedies|Crime|
        Documentary|Dramas|Faith & Spirituality|Horror|Independent|International|Kids|Korean TV Shows|LGBTQ Movies|
        Movies|Music|Mysteries|Reality TV|Romance|Sci-Fi & Fantasy|Science & Nature TV|Spanish-Language TV Shows|
        Sports Movies|Stand-Up Comedy|Teen TV Shows|Thrillers|TV Shows"""
    names = {n.strip() for n in known.split("|")}
    rows = spark.createDataFrame([(x,) for x in O.LABELS], "label string")
    assert len(O.LABELS) == 42 and len(names) == 29
    assert {r[0] for r in rows.select(normalise_genre("label")).collect()} == names


def test_suite_and_modes(spark):
    cat = Catalogue(synthetic_landing(spark, SF_SMALL, ("bad_type", "bad_rating")))
    res = {r.name: r for r in T.run_suite(cat, max_year=2027)}
    assert res["accepted_values_type"].status == "fail"
    assert res["accepted_values_audience"].status == "fail"
    assert res["unique_show_id"].status == "pass"
    assert len(res["accepted_values_type"].sample) == 1
    with pytest.raises(T.AssertionsFailed):
        T.require_all_pass(list(res.values()))
    wh, results = run(synthetic_landing(spark, SF_SMALL), max_year=2027)
    assert wh.models and all(r.status == "pass" for r in results)
    with pytest.raises(T.AssertionsFailed):
        run(synthetic_landing(spark, SF_SMALL, ("bad_type",)), max_year=2027)
    with pytest.raises(FileNotFoundError):
        require_inputs(spark, "/nonexistent/landing")


def test_broken_assertion_is_a_failure(spark):
    cat = Catalogue(synthetic_landing(spark, SF_SMALL).drop("rating"))
    res = {r.name: r for r in T.run_suite(cat, max_year=2027)}
    assert res["accepted_values_audience"].status == "fail"
    assert res["accepted_values_audience"].error


def test_models_queryable_with_sql(spark):
    wh = build(land(synthetic_landing(spark, SF_SMALL)))
    names = wh.register_views()
    assert set(names) >= {"stg_titles", "int_title_countries", "int_title_genres",
                          "int_title_people", "dim_title"}
    pairs = spark.sql("""
        SELECT a.country AS country_a, b.country AS country_b, count(*) AS co_productions
        FROM int_title_countries a
        JOIN int_title_countries b ON a.show_id = b.show_id AND a.country < b.country
        JOIN dim_title d ON d.show_id = a.show_id
        GROUP BY a.country, b.country HAVING count(*) >= 5""")
    got = {(r[0], r[1]): r[2] for r in pairs.collect()}
    want = {(r["country_a"], r["country_b"]): r["co_productions"]
            for r in A.q10_co_production(wh.catalogue).collect()}
    assert got == want


def test_csv_source_end_to_end(spark, scratch):
    from marquee.sources.landing import read_csv_landing, write_csv_landing
    path = write_csv_landing(synthetic_landing(spark, SF_SMALL), scratch + "/catalogue_csv")
    wh = build(land(read_csv_landing(spark, path, partitions=4)))
    assert {b.model: b.rows for b in wh.report}["dim_title"] == 1500
    assert all(r.status == "pass" for r in T.run_suite(wh.catalogue, max_year=2027))
    ok, msg = compare(A.q10_co_production(wh.catalogue),
                      O.with_models(O.ANALYSIS_SQL["q10_co_production"]), SF_SMALL)
    assert ok, msg


def test_build_with_repeated_keys_matches_oracle(spark):
    raw = land(synthetic_landing(spark, SF_SMALL, ("dup_keys",)))
    wh = build(raw)
    assert wh.catalogue.unique_keys is False
    rows = {b.model: b.rows for b in wh.report}
    assert rows["dim_title"] == 1503
    for key, fn in (("q04_country_production", A.q04_country_production),
                    ("q07_top_people", A.q07_top_people),
                    ("q10_co_production", A.q10_co_production)):
        ok, msg = compare(fn(wh.catalogue),
                          O.with_models(O.ANALYSIS_SQL[key], defects=("dup_keys",)), SF_SMALL)
        assert ok, (key, msg)
    ok, msg = compare(wh.models["int_title_countries"],
                      O.with_models("SELECT * FROM bc", defects=("dup_keys",)), SF_SMALL)
    assert ok, msg
