"""Data-quality assertions (T1-T10) and the suite runner (T11).

Each assertion returns the *offending rows* as a DataFrame: empty means pass.
"""

from __future__ import annotations

import datetime
import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marquee.functions import TITLE_TYPES, clean
from marquee.operators.profile import count_if_all, unpivot_counts
from marquee.plans.jobs import DEFAULT_CONCURRENT_JOBS, run_concurrently
from marquee.plans.models import Catalogue

KEY_COLUMNS = ("show_id", "title", "title_type", "release_year")
EARLIEST_YEAR = 1900


def t01_unique_show_id(cat: Catalogue) -> DataFrame:
    """Keys seen more than once (partial counts combine map-side)."""
    return (cat.mart.groupBy("show_id").agg(F.count(F.lit(1)).alias("n"))
               .filter(F.col("n") > 1))


def t02_row_count_preserved(cat: Catalogue) -> DataFrame:
    """One row (raw_rows, mart_rows) when the mart lost or gained rows."""
    raw_n = cat.raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    mart_n = cat.mart.agg(F.count(F.lit(1)).alias("mart_rows"))
    return raw_n.crossJoin(mart_n).filter(F.col("raw_rows") != F.col("mart_rows"))


def t03_not_null_keys(cat: Catalogue) -> DataFrame:
    """NULL count per key column, all four in one scan; rows with > 0."""
    counts = count_if_all(cat.mart, {c: F.col(c).isNull() for c in KEY_COLUMNS})
    return counts.filter(F.col("null_rows") > 0)


def t04_duration_units_split(cat: Catalogue) -> DataFrame:
    dm, se, tt = F.col("duration_minutes"), F.col("seasons"), F.col("title_type")
    bad = ((dm.isNotNull() & se.isNotNull()) | (dm.isNull() & se.isNull())
           | ((tt == "Movie") & dm.isNull()) | ((tt == "TV Show") & se.isNull()))
    return cat.mart.filter(bad).select("show_id", "title", "title_type", "duration_minutes", "seasons")


def t05_date_added_parsed(cat: Catalogue) -> DataFrame:
    """Landed rows with a non-blank date whose mart row has no date.

    A repeated key matches each of its undated mart rows; the mart side is
    reduced to one row per key and its number of them first, so copies meet
    a single row in the join."""
    undated = (cat.mart.filter(F.col("date_added").isNull()).groupBy(F.col("show_id").alias("_sid"))
               .agg(F.count(F.lit(1)).alias("_n")))
    dated = cat.raw.filter(clean(F.coalesce(F.col("date_added"), F.lit(""))) != "")
    met = dated.select(clean("show_id").alias("_sid"), "show_id", "date_added").join(undated, "_sid")
    return met.select("show_id", F.col("date_added").alias("raw_value"),
                      F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("col")


def t06_accepted_title_types(cat: Catalogue) -> DataFrame:
    # NOT IN: a NULL type is not reported here (T3 reports it).
    return cat.mart.filter(~F.col("title_type").isin(*TITLE_TYPES)).select("title_type").distinct()


def t07_rating_mapped(cat: Catalogue) -> DataFrame:
    return (cat.mart.filter(F.col("rating").isNotNull() & F.col("audience_band").isNull())
               .select("rating").distinct())


def t08_no_empty_tokens(cat: Catalogue) -> DataFrame:
    def bad(df: DataFrame, col: str, field: str) -> DataFrame:
        v = F.col(col)
        return df.filter((v == "") | (v != clean(v))).select(
            F.lit(field).alias("field"), v.alias("value"))
    return (bad(cat.countries, "country", "country")
            .unionByName(bad(cat.genres, "genre", "genre"))
            .unionByName(bad(cat.people, "person_name", "person")))


def t09_referential_integrity(cat: Catalogue) -> DataFrame:
    """Bridge rows whose title is missing from the mart, per bridge.

    No join: the bridges' keys and the mart's are stacked, and one aggregate
    per title (combined map-side) counts its rows in each bridge beside a
    marker of the mart.  A NULL key is in no mart."""
    bridges = {"int_title_countries": cat.countries, "int_title_genres": cat.genres,
               "int_title_people": cat.people}
    sides = [df.select("show_id", F.lit(name).alias("model")) for name, df in bridges.items()]
    stacked = functools.reduce(DataFrame.unionByName, [*sides, cat.mart.select("show_id", F.lit(None).cast("string").alias("model"))])
    titles = stacked.groupBy("show_id").agg(F.max(F.col("model").isNull()).alias("in_mart"),
                                            *[F.count_if(F.col("model") == name).alias(name) for name in bridges])
    orphans = titles.filter(~F.col("in_mart") | F.col("show_id").isNull())
    counts = orphans.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in bridges])
    return unpivot_counts(counts, list(bridges), "model", "orphans").filter("orphans > 0")


def t10_release_year_plausible(cat: Catalogue, max_year: int | None = None) -> DataFrame:
    """Release years before 1900 or after next year.  ``max_year`` defaults
    to the current year + 1; tests pass it explicitly."""
    if max_year is None:
        max_year = datetime.date.today().year + 1
    ry = F.col("release_year")
    return (cat.mart.filter((ry < EARLIEST_YEAR) | (ry > max_year))
               .select("show_id", "title", "release_year"))


ASSERTIONS = {
    "accepted_values_audience": t07_rating_mapped,
    "accepted_values_type": t06_accepted_title_types,
    "date_added_parsed": t05_date_added_parsed,
    "duration_units_split": t04_duration_units_split,
    "no_empty_tokens": t08_no_empty_tokens,
    "not_null_keys": t03_not_null_keys,
    "referential_integrity": t09_referential_integrity,
    "release_year_plausible": t10_release_year_plausible,
    "row_count_preserved": t02_row_count_preserved,
    "unique_show_id": t01_unique_show_id,
}


@dataclass
class AssertionResult:
    name: str
    status: str
    offending: int
    seconds: float
    error: str | None
    sample: list


def offenders(df: DataFrame, sample_rows: int = 5) -> tuple[int, list[dict]]:
    """Number of rows and the first ``sample_rows`` of them in order of their
    columns, from one pass: rows are counted as they flow into the bounded
    heaps (one for each task) that keep the first ones."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    first = counted.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in df.columns]).limit(sample_rows).collect()
    # Where Spark finds at run time that there are no rows, it may drop the counting with them.
    return int(seen.get["rows"]) if first else 0, [r.asDict() for r in first]


def run_suite(cat: Catalogue, sample_rows: int = 5, max_jobs: int = DEFAULT_CONCURRENT_JOBS,
              **kw) -> list[AssertionResult]:
    """T11: run every assertion; results in name order.  A query error is a
    failure; an empty result is a pass.  Only the offending count and at
    most ``sample_rows`` offending rows (the first in order of their columns)
    reach the driver.  The assertions are independent jobs and run
    ``max_jobs`` at a time."""
    try:
        cat.unique_keys  # decide the plan once, before the threads start
    except Exception:  # noqa: BLE001 - each assertion then reports the error itself
        pass

    def check(name: str):
        fn = ASSERTIONS[name]
        df = fn(cat, **kw) if name == "release_year_plausible" else fn(cat)
        return offenders(df, sample_rows)

    done = run_concurrently({n: (lambda n=n: check(n)) for n in sorted(ASSERTIONS)}, max_jobs)
    out = []
    for name, (res, secs) in done.items():
        if isinstance(res, Exception):  # a broken assertion is a failed assertion
            out.append(AssertionResult(name, "fail", -1, secs, str(res), []))
        else:
            n, sample = res
            out.append(AssertionResult(name, "pass" if n == 0 else "fail", n, secs, None, sample))
    return out


def suite_frame(spark: SparkSession, results: list[AssertionResult]) -> DataFrame:
    """The suite outcome as a small DataFrame (one row per assertion)."""
    rows = [(r.name, r.status, int(r.offending), float(r.seconds), r.error,
             [str(s) for s in r.sample]) for r in results]
    return spark.createDataFrame(
        rows, "assertion string, status string, offending bigint, seconds double, "
              "error string, sample array<string>")


def offenders_frame(spark: SparkSession, results: list[AssertionResult]) -> DataFrame:
    """The suite's offending rows: assertion, place in the sample and the values in order of their columns."""
    rows = [(r.name, k + 1, "|".join("" if v is None else str(v) for v in row.values()))
            for r in results for k, row in enumerate(r.sample)]
    return spark.createDataFrame(rows, "assertion string, place int, offender string")


class AssertionsFailed(RuntimeError):
    """Carries the names of the failed assertions."""

    def __init__(self, failed: list[str]):
        super().__init__(f"{len(failed)} assertion(s) failed: {', '.join(failed)}")
        self.failed = failed


def require_all_pass(results: list[AssertionResult]) -> None:
    """Stop a build whose assertions failed (the reference exits non-zero)."""
    failed = [r.name for r in results if r.status != "pass"]
    if failed:
        raise AssertionsFailed(failed)
