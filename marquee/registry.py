"""Registry of runnable queries and their DuckDB twins.

Every query takes ``(spark, sf_dir)``, lands the synthetic catalogue from the
driver's tables under ``sf_dir`` and returns a DataFrame.  Keys follow the
landing (or model) with the matching defect so that it must fire;
``*_dup_keys`` keys run models/analyses on a landing with duplicated keys,
which exercises the pre-aggregated (non-unique) plan.

Every query reads the whole tables.  The ``k % n`` rules that appear in the
landing and in ``MART_DROP_SQL`` define *defects* (FIXTURES.md section 4)
that make the assertions fire; they never select a subset of the data to
make a check cheaper.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import oracle as O
from marquee.operators import distribution_by_selection, exact_quantiles, running_total_by_range, weighted_pairs
from marquee.plans import analyses as A
from marquee.plans import assertions as T
from marquee.plans import report as R
from marquee.plans.build import build, land, run, run_analyses
from marquee.plans.models import Catalogue
from marquee.session import workspace_dir
from marquee.sources import landing as S
from marquee.operators.prefix import positions
from marquee.sources.sinks import (as_table, as_view, open_table, read_ordered_csv, read_result_csv, write_ordered_csv,
                                   write_result_csv)
from marquee.sources.synthetic import synthetic_landing

# Fixed for reproducible checks: the reference compares with the current
# year + 1; registered queries pin it.
MAX_YEAR = 2027
DUP = ("dup_keys",)


def _cat(spark: SparkSession, sf_dir: str, defects=(), **kw) -> Catalogue:
    return Catalogue(synthetic_landing(spark, sf_dir, defects), **kw)


def _mart_drop_col():
    return F.substring("show_id", 2, 64).try_cast("bigint") % 600 == 0


MART_DROP_SQL = "TRY_CAST(substr(s.show_id, 2) AS BIGINT) % 600 = 0"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _reg(key: str, fn, sql: str | None = None, **sql_kw) -> None:
    QUERIES[key] = fn
    if sql is not None:
        ORACLE[key] = O.with_models(sql, **sql_kw)


# -- models ----------------------------------------------------------------
_reg("m1_staging", lambda s, d: _cat(s, d).staging, "SELECT * FROM stg")
_reg("m2_country_bridge", lambda s, d: _cat(s, d).countries, "SELECT * FROM bc")
_reg("m3_genre_bridge", lambda s, d: _cat(s, d).genres, "SELECT * FROM bg")
_reg("m4_people_bridge", lambda s, d: _cat(s, d).people, "SELECT * FROM bp")
_reg("m5_title_mart", lambda s, d: _cat(s, d).mart, "SELECT * FROM mart")
_reg("m2_country_bridge_dup_keys", lambda s, d: _cat(s, d, DUP).countries,
     "SELECT * FROM bc", defects=DUP)
_reg("m3_genre_bridge_dup_keys", lambda s, d: _cat(s, d, DUP).genres,
     "SELECT * FROM bg", defects=DUP)
_reg("m4_people_bridge_dup_keys", lambda s, d: _cat(s, d, DUP).people,
     "SELECT * FROM bp", defects=DUP)
_reg("m5_title_mart_dup_keys", lambda s, d: _cat(s, d, DUP).mart,
     "SELECT * FROM mart", defects=DUP)

# -- analyses --------------------------------------------------------------
_ANALYSIS_KEYS = {
    "q01_cleaning_impact": A.q01_cleaning_impact,
    "q02_completeness": A.q02_completeness,
    "q03_catalogue_growth": A.q03_catalogue_growth,
    "q04_country_production": A.q04_country_production,
    "q05_genre_profile": A.q05_genre_profile,
    "q06_duration_distribution": A.q06_duration_distribution,
    "q07_top_people": A.q07_top_people,
    "q08_release_to_platform_lag": A.q08_release_to_platform_lag,
    "q09_audience_mix": A.q09_audience_mix,
    "q10_co_production": A.q10_co_production,
}
for _k, _fn in _ANALYSIS_KEYS.items():
    _reg(_k, (lambda fn: lambda s, d: fn(_cat(s, d)))(_fn), O.ANALYSIS_SQL[_k])
for _k in _ANALYSIS_KEYS:
    _reg(_k + "_dup_keys", (lambda fn: lambda s, d: fn(_cat(s, d, DUP)))(_ANALYSIS_KEYS[_k]),
         O.ANALYSIS_SQL[_k], defects=DUP)

_reg("q05_genre_profile_distinct_titles",
     lambda s, d: A.q05_genre_profile(_cat(s, d), distinct_titles=True),
     O.ANALYSIS_SQL["q05_genre_profile"].replace(
         "count(DISTINCT made_in) AS countries_producing",
         "count(DISTINCT made_in) AS countries_producing,\n"
         "    count(DISTINCT show_id) AS distinct_titles"))
_reg("q05_genre_profile_distinct_titles_dup_keys",
     lambda s, d: A.q05_genre_profile(_cat(s, d, DUP), distinct_titles=True),
     O.ANALYSIS_SQL["q05_genre_profile"].replace(
         "count(DISTINCT made_in) AS countries_producing",
         "count(DISTINCT made_in) AS countries_producing,\n"
         "    count(DISTINCT show_id) AS distinct_titles"), defects=DUP)

# -- assertions: clean landing (must be empty) and dirty (must fire) -------
_T_SQL = {
    "t01_unique_show_id":
        "SELECT show_id, count(*) AS n FROM mart GROUP BY show_id HAVING count(*) > 1",
    "t02_row_count_preserved": """
        SELECT r.raw_rows, m.mart_rows
        FROM (SELECT count(*) AS raw_rows FROM raw) r, (SELECT count(*) AS mart_rows FROM mart) m
        WHERE r.raw_rows <> m.mart_rows""",
    "t03_not_null_keys": """
        SELECT column_name, null_rows FROM (
            SELECT 'show_id' AS column_name, count(*) AS null_rows FROM mart WHERE show_id IS NULL
            UNION ALL SELECT 'title', count(*) FROM mart WHERE title IS NULL
            UNION ALL SELECT 'title_type', count(*) FROM mart WHERE title_type IS NULL
            UNION ALL SELECT 'release_year', count(*) FROM mart WHERE release_year IS NULL) nn
        WHERE null_rows > 0""",
    # Exactly one measure, and not the one of the other type.
    "t04_duration_units_split": """
        SELECT show_id, title, title_type, duration_minutes, seasons FROM mart
        WHERE (duration_minutes IS NULL) = (seasons IS NULL)
           OR coalesce(title_type = CASE WHEN seasons IS NULL THEN 'TV Show' ELSE 'Movie' END, FALSE)""",
    # Keys with a landed date, once for each of their mart rows that lacks one.
    "t05_date_added_parsed": """
        SELECT landed.show_id, landed.date_added AS raw_value
        FROM (SELECT *, TRIM(show_id) AS key FROM raw WHERE length(TRIM(date_added)) > 0) landed,
             (SELECT show_id AS key, unnest(range(count(*))) AS i
              FROM mart WHERE date_added IS NULL GROUP BY show_id) undated
        WHERE landed.key = undated.key""",
    "t06_accepted_title_types":
        "SELECT DISTINCT title_type FROM mart WHERE title_type NOT IN ('Movie', 'TV Show')",
    "t07_rating_mapped":
        "SELECT DISTINCT rating FROM mart WHERE rating IS NOT NULL AND audience_band IS NULL",
    # A token is itself once trimmed, and not blank.
    "t08_no_empty_tokens": """
        SELECT field, value FROM (
            FROM bc SELECT 'country' AS field, country AS value UNION ALL
            FROM bg SELECT 'genre', genre UNION ALL FROM bp SELECT 'person', person_name)
        WHERE value IS NOT NULL AND value IS DISTINCT FROM NULLIF(TRIM(value), '')""",
    "t09_referential_integrity": """
        SELECT model, count(*) AS orphans FROM (
            SELECT 'int_title_countries' AS model, show_id FROM bc UNION ALL
            SELECT 'int_title_genres', show_id FROM bg UNION ALL
            SELECT 'int_title_people', show_id FROM bp) b
        WHERE show_id NOT IN (SELECT show_id FROM mart) GROUP BY model""",
    "t10_release_year_plausible": f"""
        SELECT show_id, title, release_year FROM mart
        WHERE release_year NOT BETWEEN 1900 AND {MAX_YEAR}""",
}
_T_FN = {
    "t01_unique_show_id": (T.t01_unique_show_id, {"defects": ("dup_keys",)}),
    "t02_row_count_preserved": (T.t02_row_count_preserved, {"defects": ("null_keys",)}),
    "t03_not_null_keys": (T.t03_not_null_keys, {"defects": ("bad_year",)}),
    "t04_duration_units_split": (T.t04_duration_units_split, {"defects": ("bad_duration",)}),
    "t05_date_added_parsed": (T.t05_date_added_parsed, {"defects": ("bad_date",)}),
    "t06_accepted_title_types": (T.t06_accepted_title_types, {"defects": ("bad_type",)}),
    "t07_rating_mapped": (T.t07_rating_mapped, {"defects": ("bad_rating",)}),
    "t08_no_empty_tokens": (T.t08_no_empty_tokens, {"strict_tokens": False}),
    "t09_referential_integrity": (T.t09_referential_integrity, {"mart_drop": True}),
    "t10_release_year_plausible": (T.t10_release_year_plausible,
                                   {"defects": ("implausible_year",)}),
}


def _assertion(fn, dirty: dict | None):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        d = dirty or {}
        cat = _cat(spark, sf_dir, d.get("defects", ()),
                   strict_tokens=d.get("strict_tokens", True),
                   mart_drop=_mart_drop_col() if d.get("mart_drop") else None)
        if fn is T.t10_release_year_plausible:
            return fn(cat, max_year=MAX_YEAR)
        return fn(cat)
    return q


for _k, (_fn, _dirty) in _T_FN.items():
    _reg(_k, _assertion(_fn, None), _T_SQL[_k])
    _reg(_k + "_dirty", _assertion(_fn, _dirty), _T_SQL[_k],
         defects=_dirty.get("defects", ()),
         strict_tokens=_dirty.get("strict_tokens", True),
         mart_drop=MART_DROP_SQL if _dirty.get("mart_drop") else None)


# -- assertions on broken written tables -----------------------------------
def _broken_build(spark: SparkSession, sf_dir: str, model: str, change) -> Catalogue:
    """A finished build in which one written table is replaced by a broken one."""
    wh = build(land(synthetic_landing(spark, sf_dir)))
    broken = as_table(change(wh.models[model]), workspace_dir(spark) + "/" + model)
    return wh.catalogue.with_models({model: broken})


def _with_row(row: dict):
    """The table and one row more."""
    return lambda df: df.unionByName(df.sparkSession.createDataFrame([row], df.schema).select(df.columns))


ORPHAN = {"show_id": "nobody", "title_type": "Movie", "country": " Atlantis ", "country_position": 1,
          "is_primary_country": True, "country_count": 1}
_ORPHAN_SQL = """SELECT * FROM bc_whole UNION ALL
    SELECT 'nobody', 'Movie', ' Atlantis ', 1, TRUE, 1"""
_NO_DATES = "SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS date_added) FROM mart_whole"
_reg("t05_broken_mart_dates", lambda s, d: T.t05_date_added_parsed(_broken_build(
    s, d, "dim_title", lambda m: m.withColumn("date_added", F.lit(None).cast("timestamp_ntz")))),
    _T_SQL["t05_date_added_parsed"], broken={"mart": _NO_DATES})
_reg("t08_broken_country_bridge", lambda s, d: T.t08_no_empty_tokens(_broken_build(
    s, d, "int_title_countries", _with_row(ORPHAN))), _T_SQL["t08_no_empty_tokens"], broken={"bc": _ORPHAN_SQL})
_reg("t09_broken_country_bridge", lambda s, d: T.t09_referential_integrity(_broken_build(
    s, d, "int_title_countries", _with_row(ORPHAN))), _T_SQL["t09_referential_integrity"], broken={"bc": _ORPHAN_SQL})


# Suite inputs: the clean landing (all pass) and one with several defects.
SUITE_DEFECTS = ("bad_type", "bad_rating", "bad_duration", "implausible_year")
_SUITE_NAMES = {  # assertion name -> key of its SQL above
    "accepted_values_audience": "t07_rating_mapped",
    "accepted_values_type": "t06_accepted_title_types",
    "date_added_parsed": "t05_date_added_parsed",
    "duration_units_split": "t04_duration_units_split",
    "no_empty_tokens": "t08_no_empty_tokens",
    "not_null_keys": "t03_not_null_keys",
    "referential_integrity": "t09_referential_integrity",
    "release_year_plausible": "t10_release_year_plausible",
    "row_count_preserved": "t02_row_count_preserved",
    "unique_show_id": "t01_unique_show_id",
}
_SUITE_SQL = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS assertion, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status, "
    f"count(*) AS offending FROM ({_T_SQL[key]}) x"
    for name, key in sorted(_SUITE_NAMES.items()))


def _suite(defects=()):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = build(land(synthetic_landing(spark, sf_dir, defects)))
        results = T.run_suite(wh.catalogue, max_year=MAX_YEAR)
        return T.suite_frame(spark, results).select("assertion", "status", "offending")
    return q


_reg("t11_assertion_suite", _suite(), _SUITE_SQL)
def _test_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: a finished build opened again from its root and tested there."""
    root = build(land(synthetic_landing(spark, sf_dir, SUITE_DEFECTS))).root
    _, results = run(mode="test", root=root, max_year=MAX_YEAR, stop_on_failure=False, spark=spark)
    return T.suite_frame(spark, results).select("assertion", "status", "offending")


_reg("l2_test_only", _test_only, _SUITE_SQL, defects=SUITE_DEFECTS)
_reg("t11_assertion_suite_dirty", _suite(SUITE_DEFECTS), _SUITE_SQL, defects=SUITE_DEFECTS)

# -- the suite's offenders, its clock and its stop -------------------------
_reg("t10_release_year_this_year", lambda s, d: T.t10_release_year_plausible(_cat(s, d, ("implausible_year",))), """
    SELECT show_id, title, release_year FROM mart
    WHERE release_year NOT BETWEEN 1900 AND year(current_date) + 1""", defects=("implausible_year",))

# Columns of the assertions that fire on SUITE_DEFECTS, in their order.
_OFFENDING_COLUMNS = {
    "accepted_values_audience": ("rating",),
    "accepted_values_type": ("title_type",),
    "duration_units_split": ("show_id", "title", "title_type", "duration_minutes", "seasons"),
    "release_year_plausible": ("show_id", "title", "release_year"),
}


def _offenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T11: the first five offending rows of each assertion, in order of their columns."""
    wh = build(land(synthetic_landing(spark, sf_dir, SUITE_DEFECTS)))
    return T.offenders_frame(spark, T.run_suite(wh.catalogue, max_year=MAX_YEAR))


def _offenders_sql(name: str, columns: tuple) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    shown = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return (f"SELECT '{name}' AS assertion, place, {shown} AS offender FROM (SELECT *, CAST(row_number() OVER (ORDER BY {order}) "
            f"AS INTEGER) AS place FROM ({_T_SQL[_SUITE_NAMES[name]]}) x) y WHERE place <= 5")


_reg("t11_offenders", _offenders, "\nUNION ALL\n".join(_offenders_sql(*x) for x in _OFFENDING_COLUMNS.items()),
     defects=SUITE_DEFECTS)


def _fail_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: a run whose assertions fail stops; the assertions that stopped it."""
    try:
        run(synthetic_landing(spark, sf_dir, SUITE_DEFECTS), max_year=MAX_YEAR)
        failed = []
    except T.AssertionsFailed as stopped:
        failed = stopped.failed
    return spark.createDataFrame([(name,) for name in failed], "assertion string")


_reg("l2_fail_early", _fail_early, f"SELECT assertion FROM ({_SUITE_SQL}) suite WHERE status = 'fail'", defects=SUITE_DEFECTS)

# -- report data -----------------------------------------------------------
_Q01 = O.ANALYSIS_SQL["q01_cleaning_impact"].strip()
_Q01_BODY = _Q01[:_Q01.index("SELECT 'country'")]
_Q01_SELECT = _Q01[_Q01.index("SELECT 'country'"):]
_R_SQL = {
    "r1_overcount_ratio": f"""
        {_Q01_BODY}
        , q AS ({_Q01_SELECT})
        SELECT field, naive_distinct_count, true_distinct_count,
               CAST(naive_distinct_count AS DOUBLE) / true_distinct_count AS overcount_ratio
        FROM q""",
    "r2_completeness_long": f"""
        , q AS ({O.ANALYSIS_SQL['q02_completeness'].replace('ORDER BY titles DESC', '')})
        SELECT title_type, 'director' AS field, pct_missing_director AS pct_missing FROM q
        UNION ALL SELECT title_type, 'cast', pct_missing_cast FROM q
        UNION ALL SELECT title_type, 'country', pct_missing_country FROM q
        UNION ALL SELECT title_type, 'date_added', pct_missing_date_added FROM q
        UNION ALL SELECT title_type, 'rating', pct_missing_rating FROM q""",
    "r3_growth_highlights": f"""
        , g AS ({O.ANALYSIS_SQL['q03_catalogue_growth'].replace('ORDER BY year_added', '')})
        , s AS (SELECT * FROM g WHERE year_added <= (SELECT max(year_added) - 1 FROM g))
        , r AS (SELECT *, row_number() OVER (ORDER BY year_added) AS i,
                          row_number() OVER (ORDER BY year_added DESC) AS j,
                          row_number() OVER (ORDER BY movies_added DESC, year_added) AS p FROM s)
        SELECT max(CASE WHEN p = 1 THEN year_added END) AS peak_year,
               max(CASE WHEN p = 1 THEN movies_added END) AS peak_movies,
               max(CASE WHEN j = 1 THEN year_added END) AS last_year,
               max(CASE WHEN j = 1 THEN pct_tv END) AS last_pct_tv,
               max(CASE WHEN i = 4 THEN year_added END) AS fourth_year,
               max(CASE WHEN i = 4 THEN pct_tv END) AS fourth_pct_tv
        FROM r""",
    "r4_top_countries": f"""
        , q AS ({O.ANALYSIS_SQL['q04_country_production'].replace('ORDER BY titles DESC', '')})
        SELECT country, titles, pct_tv, co_produced_titles FROM q
        ORDER BY titles DESC, country LIMIT {R.TOP_COUNTRIES}""",
    "r5_runtime_histogram": f"""
        , c AS (SELECT CAST(least(floor((duration_minutes - {R.HIST_START}) / {R.HIST_STEP}),
                                  {R.HIST_BINS - 1}) AS INTEGER) AS bin, count(*) AS films
                FROM mart WHERE duration_minutes IS NOT NULL
                  AND duration_minutes >= {R.HIST_START}
                  AND duration_minutes <= {R.HIST_START + R.HIST_STEP * R.HIST_BINS}
                GROUP BY 1)
        SELECT CAST({R.HIST_START} + b.bin * {R.HIST_STEP} AS INTEGER) AS bin_start,
               CAST({R.HIST_START} + (b.bin + 1) * {R.HIST_STEP} AS INTEGER) AS bin_end,
               CAST(coalesce(c.films, 0) AS BIGINT) AS films
        FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({R.HIST_BINS})) b
        LEFT JOIN c ON c.bin = b.bin""",
    "r6_season_counts": f"""
        SELECT seasons, count(*) AS shows FROM mart WHERE seasons IS NOT NULL
        GROUP BY seasons HAVING seasons <= {R.MAX_SEASONS_SHOWN} ORDER BY seasons""",
    "r7_one_season_share": """
        SELECT 100.0 * avg(CASE WHEN seasons = 1 THEN 1.0 ELSE 0.0 END)::DOUBLE AS pct_one_season
        FROM mart WHERE seasons IS NOT NULL""",
    "r8_captions": """
        SELECT 'duration_minutes' AS measure, count(duration_minutes) AS n,
               min(duration_minutes) AS min_value, max(duration_minutes) AS max_value,
               median(duration_minutes) AS median_value FROM mart
        UNION ALL
        SELECT 'seasons', count(seasons), min(seasons), max(seasons), median(seasons) FROM mart""",
}
for _k, _fn in R.REPORTS.items():
    _reg(_k, (lambda fn: lambda s, d: fn(_cat(s, d)))(_fn), _R_SQL[_k])


# -- operators over wide domains and large groups ---------------------------
def _by_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q06 with quantiles by refining bins instead of a map of all values."""
    mart = _cat(spark, sf_dir).mart
    out = []
    for kind, unit, value, places in (("Movie", "minutes", "duration_minutes", 1), ("TV Show", "seasons", "seasons", 2)):
        got = distribution_by_selection(mart, value, places)
        out.append(got.select(F.lit(kind).alias("title_type"), F.lit(unit).alias("unit"), *got.columns))
    return out[0].unionByName(out[1])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_reg("q06_duration_distribution_by_selection", _by_selection, O.ANALYSIS_SQL["q06_duration_distribution"])
_reg("a9_median_lag_by_year", lambda s, d: exact_quantiles(
    _cat(s, d).mart.filter("year_added is not null"), "years_release_to_platform", [0.5], ["year_added"]).select(
        "year_added", F.col("quantiles")[0].alias("median_lag")),
    """SELECT year_added, median(years_release_to_platform) AS median_lag FROM mart WHERE year_added IS NOT NULL
       AND years_release_to_platform IS NOT NULL GROUP BY year_added""")
QUERIES["a10_price_distribution"] = lambda s, d: distribution_by_selection(
    _table(s, d, "lineitem"), "l_extendedprice", 2, 2, ["l_returnflag"])
ORACLE["a10_price_distribution"] = """
    SELECT l_returnflag, count(l_extendedprice) AS titles, min(l_extendedprice) AS min_value,
           round(quantile_cont(l_extendedprice, 0.25), 2) AS p25, round(median(l_extendedprice), 2) AS median_value,
           round(quantile_cont(l_extendedprice, 0.75), 2) AS p75, round(quantile_cont(l_extendedprice, 0.95), 2) AS p95,
           max(l_extendedprice) AS max_value, round(avg(l_extendedprice), 2) AS mean_value
    FROM lineitem GROUP BY l_returnflag"""
_reg("w2_titles_by_day", lambda s, d: running_total_by_range(
    _cat(s, d).mart.filter("date_added is not null").groupBy("date_added").agg(F.count(F.lit(1)).alias("titles")),
    ["date_added"], "titles", "cumulative_titles"),
    """SELECT date_added, count(*) AS titles, CAST(sum(count(*)) OVER (ORDER BY date_added) AS BIGINT) AS cumulative_titles
       FROM mart WHERE date_added IS NOT NULL GROUP BY date_added""")
_reg("w2_minutes_by_title", lambda s, d: running_total_by_range(
    _cat(s, d, DUP).mart.select("title_type", "show_id", "duration_minutes"), ["show_id"], "duration_minutes",
    "cumulative_minutes", ["title_type"]),
    """SELECT title_type, show_id, duration_minutes, CAST(sum(duration_minutes) OVER (
           PARTITION BY title_type ORDER BY show_id) AS BIGINT) AS cumulative_minutes FROM mart""", defects=DUP)
# Three groups of all suppliers: each far larger than a block here.
QUERIES["j3_supplier_pairs"] = lambda s, d: weighted_pairs(
    _table(s, d, "lineitem"), "l_returnflag", "l_suppkey", block=32, over_groups=True).withColumnRenamed("w", "lines")
ORACLE["j3_supplier_pairs"] = """
    WITH own AS (SELECT l_returnflag AS flag, l_suppkey AS v, count(*) AS m FROM lineitem GROUP BY ALL)
    SELECT x.v AS a, y.v AS b, CAST(sum(x.m * y.m) AS BIGINT) AS lines
    FROM own x JOIN own y ON x.flag = y.flag AND x.v < y.v GROUP BY ALL"""

# -- sources and sinks -----------------------------------------------------
def _csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1: write the landing as CSV to the shared scratch folder, land it back."""
    path = workspace_dir(spark) + "/landing_csv"
    S.write_csv_landing(synthetic_landing(spark, sf_dir), path)
    return S.read_csv_landing(spark, path, surplus=False)


def _csv_long_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1: rows of some titles carry two fields more than the header; every
    value is kept, in place or in the record of the over-long row."""
    path = workspace_dir(spark) + "/long_csv"
    k = F.substring("show_id", 2, 64).cast("bigint")
    line = F.concat_ws(",", "show_id", "title", F.when(k % 7 == 0, F.lit("more,last")))
    # Each part starts with the header, as the parts of a headed CSV folder do.
    first = F.monotonically_increasing_id() % (1 << 33) == 0
    rows = synthetic_landing(spark, sf_dir).select(
        F.when(first, F.concat(F.lit("show_id,title\n"), line)).otherwise(line).alias("value"))
    rows.write.text(path)
    return S.read_csv_landing(spark, path, expected=("show_id", "title"))


def _contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2: CSV files of the landing (whole, one column missing, one extra,
    reordered) written, and their headers read back and reported on.  The
    landing is made once and kept; its four forms are written compressed."""
    raw = land(synthetic_landing(spark, sf_dir))
    root = workspace_dir(spark)
    forms = {"whole": raw, "missing": raw.drop("rating"), "extra": raw.withColumn("note", F.lit("x")),
             "reordered": raw.select(*reversed(raw.columns))}
    found = []
    for form, df in forms.items():
        path = S.write_csv_landing(df, f"{root}/{form}", compression="gzip")
        found.append(S.contract_frame(spark, S.read_header(spark, path)).withColumn("form", F.lit(form)))
    return functools.reduce(DataFrame.unionByName, found)


def _preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9: first 25 rows of the top-people analysis in its own order."""
    return A.q07_top_people(_cat(spark, sf_dir)).limit(25)


def _layered_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 + S5-S7: land, build every layer (tables written), report rows."""
    raw = land(synthetic_landing(spark, sf_dir))
    wh = build(raw)
    return wh.report_frame(spark).select("layer", "model", "materialisation", "rows")


_reg("s1_csv_landing", _csv_landing, "SELECT * FROM raw")
_reg("s1_csv_long_rows", _csv_long_rows, """
    SELECT show_id, title, CASE WHEN CAST(substr(show_id, 2) AS BIGINT) % 7 = 0
                                THEN concat_ws(',', show_id, title, 'more', 'last') END AS surplus_fields
    FROM raw""")
_reg("s2_landing_contract", _contract, """
    SELECT column_name, CASE WHEN form = 'missing' AND column_name = 'rating' THEN 'missing'
                             ELSE 'expected' END AS status, form
    FROM (DESCRIBE SELECT * FROM raw), (SELECT unnest(['whole', 'missing', 'extra', 'reordered']) AS form)
    UNION ALL SELECT 'note', 'extra', 'extra'""")
_reg("s3_landing_profile", lambda s, d: S.landing_profile(synthetic_landing(s, d)), """
    , p AS (UNPIVOT (SELECT """ + ", ".join(
        f'count(*) FILTER (WHERE "{c}" IS NULL) AS "{c}"' for c in S.RAW_COLUMNS
    ) + """ FROM raw) ON COLUMNS(*) INTO NAME column_name VALUE null_rows)
    SELECT column_name, null_rows FROM p WHERE null_rows > 0""")
_reg("s4_landing_size", lambda s, d: S.landing_size(synthetic_landing(s, d)),
     "SELECT count(*) AS rows, CAST(12 AS BIGINT) AS columns FROM raw")


def _stored(of):
    """S3, S4: from the footers of the written landing."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = workspace_dir(spark) + "/raw"
        as_table(synthetic_landing(spark, sf_dir), path)
        return of(spark, path)
    return q


for _k, _fn in {"s3_landing_profile": S.stored_profile, "s4_landing_size": S.stored_size}.items():
    QUERIES[_k + "_stored"], ORACLE[_k + "_stored"] = _stored(_fn), ORACLE[_k]
_reg("s9_preview_top_people", _preview,
     O.ANALYSIS_SQL["q07_top_people"].replace("ORDER BY credits DESC",
                                              "ORDER BY credits DESC, person_name, role LIMIT 25"))
def _view_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5: staging registered as a view and read back by name."""
    return as_view(_cat(spark, sf_dir).staging, "stg_titles_roundtrip")


def _table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6: the mart written as a Parquet table and read back."""
    return as_table(_cat(spark, sf_dir).mart, workspace_dir(spark) + "/dim_title")


def _replaced_from_itself(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6: a table replaced from itself while an earlier reader still holds it."""
    path = workspace_dir(spark) + "/dim_title"
    before = as_table(_cat(spark, sf_dir).mart, path)
    after = as_table(before.filter("title_type = 'Movie'"), path)
    rows = {"before": before, "after": after, "opened": open_table(spark, path)}
    return functools.reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("reader"), "rows") for name, df in rows.items()])


def _csv_result_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + S10: an analysis written as headed CSV and read back typed."""
    q = A.q04_country_production(_cat(spark, sf_dir))
    path = write_result_csv(q, workspace_dir(spark) + "/04_country_production")
    return read_result_csv(spark, path, q.schema, A.sort_keys("04_country_production"))


def _csv_result_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + S10: values with white space at their edges, in several sorted parts."""
    q = _cat(spark, sf_dir).staging.select("show_id", F.concat(F.lit("\t"), "title", F.lit(" ")).alias("title"))
    path = write_result_csv(q.repartitionByRange(4, "show_id").sortWithinPartitions("show_id"),
                            workspace_dir(spark) + "/edges")
    return read_result_csv(spark, path, q.schema, [F.col("show_id")])


def _csv_result_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10: rows re-read in their order without a sort; ``place`` numbers them as they come."""
    q = _cat(spark, sf_dir).staging.select("show_id", "title")
    path = write_ordered_csv(q, workspace_dir(spark) + "/ordered", [F.desc("title"), "show_id"], parts=6)
    back = read_ordered_csv(spark, path, q.schema).withColumn("_id", F.monotonically_increasing_id())
    return positions(back, [F.col("_id")], out="place").drop("_id")


def _analysis_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: every analysis run, written and previewed; (analysis, rows)."""
    cat = build(land(synthetic_landing(spark, sf_dir))).catalogue
    out = run_analyses(cat, out_dir=workspace_dir(spark) + "/results")
    return spark.createDataFrame([(o["analysis"], int(o["rows"])) for o in out],
                                 "analysis string, rows bigint")


_ANALYSIS_SQL_KEYS = {name: ("q" + name if not name.startswith("10_") else "q10_co_production")
                      for name in A.ANALYSES}
_reg("s5_view_roundtrip", _view_roundtrip, "SELECT * FROM stg")
_reg("s6_table_roundtrip", _table_roundtrip, "SELECT * FROM mart")
_reg("s6_replace_from_itself", _replaced_from_itself, """
    SELECT 'before' AS reader, count(*) AS rows FROM mart
    UNION ALL SELECT unnest(['after', 'opened']), count(*) FROM mart WHERE title_type = 'Movie'""")
_reg("s8_result_csv_edges", _csv_result_edges, "SELECT show_id, chr(9) || title || ' ' AS title FROM stg")
_reg("s10_result_in_order", _csv_result_in_order, """
    SELECT show_id, title, row_number() OVER (ORDER BY title DESC NULLS LAST, show_id) - 1 AS place FROM stg""")
_reg("s8_result_csv_roundtrip", _csv_result_roundtrip, O.ANALYSIS_SQL["q04_country_production"])
_reg("l3_run_analyses", _analysis_run, _Q01_BODY + f"\n, q01 AS ({_Q01_SELECT})\n" + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS analysis, count(*) AS rows FROM "
    + ("q01" if name.startswith("01_") else f"({O.ANALYSIS_SQL[key]})") + " x"
    for name, key in sorted(_ANALYSIS_SQL_KEYS.items())))
_reg("l1_layered_build", _layered_build, """
    SELECT 'staging' AS layer, 'stg_titles' AS model, 'view' AS materialisation,
           (SELECT count(*) FROM stg) AS rows
    UNION ALL SELECT 'intermediate', 'int_title_countries', 'table', (SELECT count(*) FROM bc)
    UNION ALL SELECT 'intermediate', 'int_title_genres', 'table', (SELECT count(*) FROM bg)
    UNION ALL SELECT 'intermediate', 'int_title_people', 'table', (SELECT count(*) FROM bp)
    UNION ALL SELECT 'marts', 'dim_title', 'table', (SELECT count(*) FROM mart)""")
