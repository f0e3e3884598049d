"""Exact quantiles by refining bins, against ``percentile``."""

import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import exact_quantiles

PROBABILITIES = [0.25, 0.5, 0.75, 0.95, 0.0, 1.0]


def percentiles(df, groups):
    at = F.percentile("v", F.array(*[F.lit(p) for p in PROBABILITIES]))
    return {tuple(r)[:-1]: r["q"] for r in df.filter("v is not null").groupBy(*groups).agg(at.alias("q")).collect()}


def drawn(seed, n):
    rng = random.Random(seed)
    kinds = [lambda: None, lambda: rng.gauss(0, 1), lambda: rng.gauss(0, 1) * 10.0 ** rng.randint(-300, 300),
             lambda: float(rng.randint(-3, 3)), lambda: float("inf"), lambda: 5e-324, lambda: 0.0]
    rows = [(rng.choice(["a", "b", None]), rng.choice(kinds)()) for _ in range(n)]
    return [*rows, ("one", 3.0), ("none", None), *[("hot", 7.0)] * (n // 2)]


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_equal_to_percentile(spark, groups):
    df = spark.createDataFrame(drawn(1, 3000), "g string, v double")
    got = {tuple(r)[:-1]: r["quantiles"] for r in exact_quantiles(df, "v", PROBABILITIES, groups, bins=16).collect()}
    assert got == percentiles(df, groups)


def test_many_distinct_values_take_few_passes(spark, monkeypatch):
    from marquee.operators import selection
    passes = []
    narrowed = selection._narrowed
    monkeypatch.setattr(selection, "_narrowed", lambda *a: passes.append(1) or narrowed(*a))
    df = spark.range(300_000).select(F.lit("x").alias("g"), (F.rand(3) * 1e6 - F.pow(F.rand(4), F.lit(5.0)) * 1e9).alias("v"))
    df.cache()
    assert {(): exact_quantiles(df, "v", PROBABILITIES).first()["quantiles"]} == percentiles(df, [])
    assert len(passes) <= 5


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(empty, "v", [0.5]).count() == 0 and exact_quantiles(empty, "v", [0.5], ["g"]).count() == 0
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, float("nan")), ("a", 3, 3.0)], "_v string, _n int, _low double")
    assert [tuple(r) for r in exact_quantiles(df, "_low", [0.0, 0.5], ["_v"], "q").collect()] == [("a", [1.0, 3.0])]
    whole = exact_quantiles(df, "_n", [0.5, 0.25]).first()["quantiles"]
    assert whole == [2.0, 1.5]


def test_interpolation_from_the_lower_value(spark):
    """As the reference engine, which the last bit decides before rounding; odd values as before."""
    from marquee.operators import distribution_by_selection
    values = [1.0, 81356.76, 81386.74, 90000.0, 100000.0, 110000.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_quantiles(df, "v", [0.25], from_low=True).first()["quantiles"] == [81356.76 + 0.25 * (81386.74 - 81356.76)]
    assert distribution_by_selection(df, "v", 2, 2).first()["p25"] == 81364.26
    odd = spark.createDataFrame([("a", float("-inf")), ("a", 5.0), ("b", -1e308), ("b", 1.5e308), ("c", 5.0), ("c", float("nan"))],
                                "g string, v double")
    got = {r["g"]: r["quantiles"][0] for r in exact_quantiles(odd, "v", [0.25], ["g"], from_low=True).collect()}
    assert (got["a"], got["b"]) == (float("-inf"), 0.75 * -1e308 + 0.25 * 1.5e308) and got["c"] != got["c"]
