"""Distribution summaries (count, min, quartiles, median, p95, max, mean)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import round_half_away
from marquee.operators.selection import exact_quantiles

QUANTILES = (0.25, 0.5, 0.75, 0.95)


def distribution_summary(c: Column, mean_places: int, approx: bool = False,
                         accuracy: int = 10000) -> list[Column]:
    """Aggregate expressions for one measure (NULLs ignored).

    The exact form uses ``percentile`` (continuous, linear interpolation, same
    as QUANTILE_CONT / MEDIAN); its buffer is a value -> count map, so it stays
    small for the low-cardinality integer measures here and merges map-side.
    ``approx=True`` switches to ``percentile_approx`` for wide domains;
    ``distribution_by_selection`` is exact there.
    """
    if approx:
        qs = F.percentile_approx(c, list(QUANTILES), accuracy).cast("array<double>")
    else:
        qs = F.percentile(c, F.array(*[F.lit(q) for q in QUANTILES]))
    return [
        F.count(c).alias("titles"),
        F.min(c).alias("min_value"),
        round_half_away(qs[0], 0).alias("p25"),
        round_half_away(qs[1], 0).alias("median_value"),
        round_half_away(qs[2], 0).alias("p75"),
        round_half_away(qs[3], 0).alias("p95"),
        F.max(c).alias("max_value"),
        round_half_away(F.avg(c), mean_places).alias("mean_value"),
    ]


def distribution_by_selection(df: DataFrame, value: str, mean_places: int, places: int = 0,
                              groups: list[str] | None = None) -> DataFrame:
    """The same summary, exact, for measures of any number of distinct values.

    One row per group (NULL is a group) with a non-null value; quantiles by
    ``exact_quantiles`` with the reference engine's interpolation, the rest by
    one aggregate."""
    groups = groups or []
    c = F.col(value)
    rest = df.groupBy(*groups).agg(F.count(c).alias("titles"), F.min(c).alias("min_value"), F.max(c).alias("max_value"),
                                   round_half_away(F.avg(c), mean_places).alias("mean_value"))
    same = F.lit(True)
    for g in groups:
        same = same & F.col(f"r.`{g}`").eqNullSafe(F.col(f"q.`{g}`"))
    met = rest.alias("r").join(exact_quantiles(df, value, list(QUANTILES), groups, from_low=True).alias("q"), same)
    names = ("p25", "median_value", "p75", "p95")
    at = [round_half_away(F.col("quantiles")[k], places).alias(n) for k, n in enumerate(names)]
    return met.select(*[f"r.`{g}`" for g in groups], "titles", "min_value", *at, "max_value", "mean_value")
