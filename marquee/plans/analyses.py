"""The ten analyses (Q01-Q10) over a built ``Catalogue``.

Bridge x mart analyses (Q04, Q05, Q07, Q10) join their bridge to the mart
reduced to one row per title; the final group-by is combined map-side, so a
hot group key such as one very common country costs a row for each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import clean, pct, round_half_away, safe_ratio
from marquee.operators import (
    distinct_from_sketches, distribution_summary, running_total, share_of_total, share_within,
)
from marquee.plans.models import Catalogue
from marquee.session import workspace_dir
from marquee.sources.sinks import as_table


def _flag_sum(cond: Column, weight: Column | None = None) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END), optionally weighted, as BIGINT."""
    one = F.lit(1).cast("bigint") if weight is None else weight
    return F.sum(F.when(cond, one).otherwise(F.lit(0).cast("bigint"))).cast("bigint")


def _wavg(sum_col: str, cnt_col: str, weight: Column | None = None) -> Column:
    s, c = F.col(sum_col), F.col(cnt_col)
    if weight is not None:
        s, c = s * weight, c * weight
    return safe_ratio(F.sum(s), F.sum(c))


def _distinct(approx: bool):
    """Exact COUNT(DISTINCT) or, for very large data, HyperLogLog++."""
    return (lambda c: F.approx_count_distinct(c)) if approx else F.count_distinct


# The three rows of the cleaning-impact table.
IMPACT_FIELDS = ("country", "genre (platform labels)", "genre (normalised)")


def q01_cleaning_impact(cat: Catalogue, approx: bool = False) -> DataFrame:
    """Naive distinct count of the packed column vs the exploded one."""
    distinct = _distinct(approx)
    raw = cat.raw.agg(distinct(clean("country")).alias("raw_country"),
                      distinct(clean("listed_in")).alias("raw_genre"))
    ctry = cat.countries.agg(distinct("country").alias("real_countries"))
    gen = cat.genres.agg(distinct("genre").alias("labels"),
                         distinct("genre_normalised").alias("normalised"))
    return _impact(raw.crossJoin(ctry).crossJoin(gen))  # three one-row aggregates


def _impact(one: DataFrame) -> DataFrame:
    """Q01's three rows from its five counts."""
    rows = F.array(
        F.struct(F.lit(IMPACT_FIELDS[0]).alias("field"), F.col("raw_country").alias("naive"),
                 F.col("real_countries").alias("true")),
        F.struct(F.lit(IMPACT_FIELDS[1]).alias("field"),
                 F.col("raw_genre").alias("naive"), F.col("labels").alias("true")),
        F.struct(F.lit(IMPACT_FIELDS[2]).alias("field"),
                 F.col("raw_genre").alias("naive"), F.col("normalised").alias("true")),
    )
    return one.select(F.inline(rows)).select(
        "field",
        F.col("naive").cast("bigint").alias("naive_distinct_count"),
        F.col("true").cast("bigint").alias("true_distinct_count"),
        (F.col("naive") - F.col("true")).cast("bigint").alias("overcount"))


def q01_from_sketches(sketches: DataFrame) -> DataFrame:
    """Q01 estimated from a build's kept sketches (``Warehouse.keep_sketches``): no table is read."""
    n = distinct_from_sketches(sketches, ["table"])
    at = lambda t, c: F.max(F.when((F.col("table") == t) & (F.col("column_name") == c), F.col("distinct_values")))
    one = n.agg(at("raw", "country").alias("raw_country"), at("raw", "listed_in").alias("raw_genre"),
                at("int_title_countries", "country").alias("real_countries"),
                at("int_title_genres", "genre").alias("labels"),
                at("int_title_genres", "genre_normalised").alias("normalised"))
    return _impact(one)


def q02_completeness(cat: Catalogue) -> DataFrame:
    m = cat.mart
    n = F.count(F.lit(1))
    flags = ["director", "cast", "country", "date_added", "rating"]
    return (m.groupBy("title_type")
             .agg(n.alias("titles"),
                  *[pct(_flag_sum(F.col(f"missing_{f}")), n, 1).alias(f"pct_missing_{f}")
                    for f in flags],
                  round_half_away(F.avg("completeness_score"), 2).alias("avg_completeness_score"),
                  pct(_flag_sum(F.col("completeness_score") == 5), n, 1).alias("pct_fully_complete"))
             .orderBy(F.desc("titles"), F.asc_nulls_last("title_type")))


def q03_catalogue_growth(cat: Catalogue) -> DataFrame:
    m = cat.mart.filter(F.col("year_added").isNotNull())
    n = F.count(F.lit(1))
    g = m.groupBy("year_added").agg(
        n.alias("titles_added"),
        _flag_sum(F.col("title_type") == "Movie").alias("movies_added"),
        _flag_sum(F.col("title_type") == "TV Show").alias("shows_added"),
        pct(_flag_sum(F.col("title_type") == "TV Show"), n, 1).alias("pct_tv"),
        round_half_away(F.avg("years_release_to_platform"), 1).alias("avg_years_since_release"),
        round_half_away(F.median("years_release_to_platform"), 1).alias("median_years_since_release"),
    )
    return running_total(g, "year_added", "titles_added", "cumulative_titles").orderBy("year_added")


def _shared(both: DataFrame, count_col: str, out: str, places: int) -> DataFrame:
    """Group rows with their share of the grand total.  ``both`` holds the
    groups and the total (``whole`` = 1) from one aggregate; it is written, so
    that the join and aggregate behind it run once."""
    kept = as_table(both, workspace_dir(both.sparkSession) + "/groups")
    total = kept.filter("whole = 1").select(F.col(count_col).alias("total"))
    return share_of_total(kept.filter("whole = 0").drop("whole"), total, count_col, out, places)


def _group_sums(groups: DataFrame, key: str, counts: list[str], more: list[Column]) -> DataFrame:
    """The groups (``whole`` = 0) and their grand total (1) by grouping sets.
    ``groups`` has one row per key, so that few rows are spread to both sets."""
    return groups.groupingSets([[key], []], key).agg(
        F.grouping(key).alias("whole"), *[F.sum(c).cast("bigint").alias(c) for c in counts], *more)


def country_credits(cat: Catalogue) -> DataFrame:
    """Q04's groups and grand total, from one bridge x mart join."""
    w = F.col("n_rows")
    counts = {
        "titles": F.sum(w), "primary_titles": _flag_sum(F.col("is_primary_country"), w),
        "co_produced_titles": _flag_sum(F.col("country_count") > 1, w),
        "movies": _flag_sum(F.col("title_type") == "Movie", w),
        "tv_shows": _flag_sum(F.col("title_type") == "TV Show", w),
    }
    groups = cat.bridge_facts(cat.countries).groupBy("country").agg(
        *[c.alias(n) for n, c in counts.items()], *[F.sum(c).alias(c) for c in ("ry_sum", "ry_cnt")])
    return _group_sums(groups, "country", list(counts),
                       [round_half_away(_wavg("ry_sum", "ry_cnt"), 0).alias("avg_release_year")])


def q04_country_production(cat: Catalogue) -> DataFrame:
    out = _shared(country_credits(cat), "titles", "pct_of_all_credits", 2).withColumn("pct_tv", pct("tv_shows", "titles", 1))
    return out.select("country", "titles", "primary_titles", "co_produced_titles", "movies",
                      "tv_shows", "pct_tv", "avg_release_year", "pct_of_all_credits") \
              .orderBy(F.desc("titles"), "country")


def genre_tags(cat: Catalogue, distinct_titles: bool = False, approx: bool = False) -> DataFrame:
    """Q05's groups and grand total by grouping sets over one bridge x mart
    join; rows are first reduced to one for each (genre, title)."""
    w = F.col("n_rows")
    sums = ["ry_sum", "ry_cnt", "dm_sum", "dm_cnt", "se_sum", "se_cnt"]
    per = cat.bridge_facts(cat.genres).groupBy("genre_normalised", "show_id").agg(
        F.sum(w).alias("tags"),
        _flag_sum(F.col("title_type") == "Movie", w).alias("movies"),
        _flag_sum(F.col("title_type") == "TV Show", w).alias("tv_shows"),
        F.max("primary_country").alias("primary_country"), *[F.sum(c).alias(c) for c in sums])
    extra = [F.count(F.lit(1)).alias("distinct_titles")] if distinct_titles else []
    counts = ["titles", "movies", "tv_shows", *(["distinct_titles"] if distinct_titles else [])]
    groups = per.groupBy(F.col("genre_normalised").alias("genre")).agg(
        *extra, F.sum("tags").alias("titles"), F.sum("movies").alias("movies"), F.sum("tv_shows").alias("tv_shows"),
        *[F.sum(c).alias(c) for c in sums], _distinct(approx)("primary_country").alias("countries"))
    return _group_sums(groups, "genre", counts, [
        round_half_away(_wavg("dm_sum", "dm_cnt"), 1).alias("avg_movie_minutes"),
        round_half_away(_wavg("se_sum", "se_cnt"), 2).alias("avg_seasons"),
        round_half_away(_wavg("ry_sum", "ry_cnt"), 0).alias("avg_release_year"),
        # A group has one row here; the total's value means nothing and isn't used.
        F.max("countries").alias("countries_producing")])


def q05_genre_profile(cat: Catalogue, distinct_titles: bool = False,
                      approx: bool = False) -> DataFrame:
    """Genre mix over normalised labels.  ``titles`` counts genre *tags*: a
    title with two labels of one normalised genre counts twice, as in the
    reference.  ``distinct_titles=True`` adds the number of distinct titles
    per genre as an extra column."""
    out = _shared(genre_tags(cat, distinct_titles, approx), "titles", "pct_of_genre_tags", 2)
    return out.select("genre", "titles", "movies", "tv_shows", "pct_of_genre_tags",
                      "avg_movie_minutes", "avg_seasons", "avg_release_year",
                      "countries_producing", *(["distinct_titles"] if distinct_titles else []))\
              .orderBy(F.desc("titles"), "genre")


def q06_duration_distribution(cat: Catalogue, approx: bool = False) -> DataFrame:
    """Both measures in one scan of the mart, then one row per measure."""
    m = cat.mart
    one = m.agg(
        F.struct(*distribution_summary(F.col("duration_minutes"), 1, approx)).alias("movie"),
        F.struct(*distribution_summary(F.col("seasons"), 2, approx)).alias("tv"))
    rows = F.array(
        F.struct(F.lit("Movie").alias("title_type"), F.lit("minutes").alias("unit"), F.col("movie.*")),
        F.struct(F.lit("TV Show").alias("title_type"), F.lit("seasons").alias("unit"), F.col("tv.*")),
    )
    return one.select(F.inline(rows))


def q07_top_people(cat: Catalogue, min_credits: int = 10, approx: bool = False) -> DataFrame:
    w = F.col("n_rows")
    return (cat.bridge_facts(cat.people).groupBy("person_name", "role")
             .agg(F.sum(w).cast("bigint").alias("credits"),
                  _flag_sum(F.col("title_type") == "Movie", w).alias("movies"),
                  _flag_sum(F.col("title_type") == "TV Show", w).alias("tv_shows"),
                  _flag_sum(F.col("is_top_billed"), w).alias("top_billed_credits"),
                  _distinct(approx)("primary_country").alias("countries"),
                  F.min("ry_min").alias("first_year"),
                  F.max("ry_max").alias("last_year"))
             .filter(F.col("credits") >= min_credits)
             .orderBy(F.desc("credits"), "person_name", "role"))


def q08_release_to_platform_lag(cat: Catalogue) -> DataFrame:
    lag = F.col("years_release_to_platform")
    m = cat.mart.filter(F.col("year_added").isNotNull() & lag.isNotNull())
    n = F.count(F.lit(1))
    return (m.groupBy("year_added")
             .agg(n.alias("titles"),
                  round_half_away(F.avg(lag), 2).alias("avg_lag_years"),
                  round_half_away(F.median(lag), 1).alias("median_lag_years"),
                  _flag_sum(lag <= 0).alias("same_year_or_earlier"),
                  pct(_flag_sum(lag <= 0), n, 1).alias("pct_same_year"),
                  _flag_sum(lag > 10).alias("back_catalogue_over_10y"),
                  pct(_flag_sum(lag > 10), n, 1).alias("pct_back_catalogue"))
             .orderBy("year_added"))


def q09_audience_mix(cat: Catalogue) -> DataFrame:
    m = cat.mart.filter(F.col("year_added").isNotNull() & F.col("audience_band").isNotNull())
    g = m.groupBy("year_added", "audience_band").agg(
        F.count(F.lit(1)).alias("titles"),
        round_half_away(F.avg("duration_minutes"), 0).alias("avg_movie_minutes"))
    out = share_within(g, "year_added", "titles", "pct_of_year", 1)
    return out.select("year_added", "audience_band", "titles", "pct_of_year",
                      "avg_movie_minutes").orderBy("year_added", F.desc("titles"), "audience_band")


def q10_co_production(cat: Catalogue, min_pairs: int = 5) -> DataFrame:
    """Country pairs per title from the title's own distinct countries
    (weighted by multiplicity and by the title's mart rows), then one
    group-by on the pair.  No self-join."""
    w = F.col("w")
    return (cat.pair_facts().groupBy(F.col("a").alias("country_a"), F.col("b").alias("country_b"))
             .agg(F.sum(w * F.col("n_rows")).cast("bigint").alias("co_productions"),
                  F.sum(w * F.col("n_movies")).cast("bigint").alias("movies"),
                  F.sum(w * F.col("n_tv")).cast("bigint").alias("tv_shows"),
                  round_half_away(_wavg("ry_sum", "ry_cnt", w), 0).alias("avg_release_year"))
             .filter(F.col("co_productions") >= min_pairs)
             .orderBy(F.desc("co_productions"), "country_a", "country_b"))


ANALYSES = {
    "01_cleaning_impact": q01_cleaning_impact,
    "02_completeness": q02_completeness,
    "03_catalogue_growth": q03_catalogue_growth,
    "04_country_production": q04_country_production,
    "05_genre_profile": q05_genre_profile,
    "06_duration_distribution": q06_duration_distribution,
    "07_top_people": q07_top_people,
    "08_release_to_platform_lag": q08_release_to_platform_lag,
    "09_audience_mix": q09_audience_mix,
    "10_co_production_network": q10_co_production,
}

# Each analysis' own sort keys, for reading a written result back in order.
ORDER = {
    "01_cleaning_impact": (),
    "02_completeness": (F.desc, "titles", "title_type"),
    "03_catalogue_growth": ("year_added",),
    "04_country_production": (F.desc, "titles", "country"),
    "05_genre_profile": (F.desc, "titles", "genre"),
    "06_duration_distribution": (),
    "07_top_people": (F.desc, "credits", "person_name", "role"),
    "08_release_to_platform_lag": ("year_added",),
    "09_audience_mix": ("year_added", F.desc, "titles", "audience_band"),
    "10_co_production_network": (F.desc, "co_productions", "country_a", "country_b"),
}


def sort_keys(name: str) -> list:
    """The sort keys of an analysis as columns (NULLs of ascending keys last)."""
    keys, descending = [], False
    for part in ORDER[name]:
        if part is F.desc:
            descending = True
            continue
        keys.append(F.desc(part) if descending else F.asc_nulls_last(part))
        descending = False
    return keys
