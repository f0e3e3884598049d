"""Chart-ready data (R1-R8): the data steps behind the reference's charts.

Drawing is not built; these return the small tables a plotting tool reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.plans.analyses import q01_cleaning_impact, q02_completeness, q03_catalogue_growth, \
    q04_country_production
from marquee.plans.models import Catalogue

# Runtime histogram edges 0, 5, ..., 205 (41 bins, the last
# one closed on the right); values outside [0, 205] are not counted.
HIST_START, HIST_STEP, HIST_BINS = 0, 5, 41
MAX_SEASONS_SHOWN = 10
TOP_COUNTRIES = 15


def r1_overcount_ratio(cat: Catalogue) -> DataFrame:
    q = q01_cleaning_impact(cat)
    return q.select("field", "naive_distinct_count", "true_distinct_count",
                    (F.col("naive_distinct_count") / F.col("true_distinct_count"))
                    .alias("overcount_ratio"))


def r2_completeness_long(cat: Catalogue) -> DataFrame:
    """Completeness by type, wide -> long (one row per type and field)."""
    q = q02_completeness(cat)
    fields = ["director", "cast", "country", "date_added", "rating"]
    long = q.unpivot(["title_type"], [f"pct_missing_{f}" for f in fields], "metric", "pct_missing")
    return long.select("title_type",
                       F.regexp_replace("metric", "^pct_missing_", "").alias("field"),
                       "pct_missing")


def r3_growth_highlights(cat: Catalogue, last_full_year: int | None = None) -> DataFrame:
    """Growth series cut at the last full year (default: the latest year
    minus one, as the extract stops inside its last year), with the peak
    film year and the TV share of the last and of the fourth year."""
    g = q03_catalogue_growth(cat)
    if last_full_year is None:
        cut = g.agg((F.max("year_added") - 1).alias("_cut"))
    else:
        cut = g.sparkSession.range(1).select(F.lit(last_full_year).cast("bigint").alias("_cut"))
    s = g.crossJoin(F.broadcast(cut)).filter(F.col("year_added") <= F.col("_cut"))
    by_year = Window.orderBy("year_added")
    by_peak = Window.orderBy(F.desc("movies_added"), "year_added")
    ranked = s.select("year_added", "movies_added", "pct_tv",
                      F.row_number().over(by_year).alias("_i"),
                      F.row_number().over(by_year.orderBy(F.desc("year_added"))).alias("_j"),
                      F.row_number().over(by_peak).alias("_p"))
    return ranked.agg(
        F.max(F.when(F.col("_p") == 1, F.col("year_added"))).alias("peak_year"),
        F.max(F.when(F.col("_p") == 1, F.col("movies_added"))).alias("peak_movies"),
        F.max(F.when(F.col("_j") == 1, F.col("year_added"))).alias("last_year"),
        F.max(F.when(F.col("_j") == 1, F.col("pct_tv"))).alias("last_pct_tv"),
        F.max(F.when(F.col("_i") == 4, F.col("year_added"))).alias("fourth_year"),
        F.max(F.when(F.col("_i") == 4, F.col("pct_tv"))).alias("fourth_pct_tv"),
    )


def r4_top_countries(cat: Catalogue, n: int = TOP_COUNTRIES) -> DataFrame:
    """The n countries with most titles, listed ascending (bar-chart order)."""
    q = q04_country_production(cat)
    top = q.orderBy(F.desc("titles"), "country").limit(n)
    return top.select("country", "titles", "pct_tv", "co_produced_titles") \
              .orderBy("titles", F.desc("country"))


def country_lookup(cat: Catalogue, country: str) -> DataFrame:
    """One country's row of the country production table."""
    return q04_country_production(cat).filter(F.col("country") == country)


def r5_runtime_histogram(cat: Catalogue) -> DataFrame:
    """Film counts per 5-minute bin over [0, 205]; empty bins are kept."""
    x = F.col("duration_minutes")
    hi = HIST_START + HIST_STEP * HIST_BINS
    b = F.least(F.floor((x - HIST_START) / HIST_STEP), F.lit(HIST_BINS - 1)).cast("int")
    counts = (cat.mart.filter(x.isNotNull() & (x >= HIST_START) & (x <= hi))
                 .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("films")))
    bins = cat.mart.sparkSession.range(HIST_BINS).select(F.col("id").cast("int").alias("bin"))
    return (bins.join(F.broadcast(counts), "bin", "left")
                .select((F.lit(HIST_START) + F.col("bin") * HIST_STEP).alias("bin_start"),
                        (F.lit(HIST_START) + (F.col("bin") + 1) * HIST_STEP).alias("bin_end"),
                        F.coalesce("films", F.lit(0)).cast("bigint").alias("films")))


def r6_season_counts(cat: Catalogue, max_seasons: int = MAX_SEASONS_SHOWN) -> DataFrame:
    s = F.col("seasons")
    return (cat.mart.filter(s.isNotNull()).groupBy("seasons")
               .agg(F.count(F.lit(1)).alias("shows"))
               .filter(s <= max_seasons).orderBy("seasons"))


def r7_one_season_share(cat: Catalogue) -> DataFrame:
    s = F.col("seasons")
    return (cat.mart.filter(s.isNotNull())
               .agg((F.lit(100.0) * F.avg(F.when(s == 1, 1.0).otherwise(0.0)))
                    .alias("pct_one_season")))


def r8_captions(cat: Catalogue) -> DataFrame:
    """n, min, max, median of runtime (films) and of seasons (shows)."""
    m = cat.mart

    def summary(c: str):
        x = F.col(c)
        return F.struct(F.count(x).alias("n"), F.min(x).alias("min_value"),
                        F.max(x).alias("max_value"), F.median(x).alias("median_value"))
    one = m.agg(summary("duration_minutes").alias("a"), summary("seasons").alias("b"))
    rows = F.array(F.struct(F.lit("duration_minutes").alias("measure"), F.col("a.*")),
                   F.struct(F.lit("seasons").alias("measure"), F.col("b.*")))
    return one.select(F.inline(rows))


REPORTS = {
    "r1_overcount_ratio": r1_overcount_ratio,
    "r2_completeness_long": r2_completeness_long,
    "r3_growth_highlights": r3_growth_highlights,
    "r4_top_countries": r4_top_countries,
    "r5_runtime_histogram": r5_runtime_histogram,
    "r6_season_counts": r6_season_counts,
    "r7_one_season_share": r7_one_season_share,
    "r8_captions": r8_captions,
}
