"""Every registered query against its DuckDB twin (the driver's gate),
at the smallest scale; queries without SQL get a rows check."""

import pytest

import __spark_entry__ as E
from marquee.registry import ORACLE, QUERIES
from tests.compare import compare
from tests.conftest import SF_SMALL

KEYS = sorted(QUERIES)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["country_a", "country_b", "co_productions", "movies", "tv_shows",
                          "avg_release_year"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(E.queries()) >= set(E.oracle_sql()) >= set(ORACLE)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert df.count() > 0
        return
    ok, msg = compare(df, sql, SF_SMALL)
    assert ok, msg


@pytest.mark.parametrize("key", [k for k in KEYS if k.startswith(("t05_broken", "t08_broken", "t09_broken"))])
def test_assertions_fire_on_broken_tables(spark, key):
    assert E.queries()[key](spark, SF_SMALL).count() > 0


@pytest.mark.parametrize("key", [k for k in KEYS if k.endswith("_dirty")
                                 and not k.startswith("t11")])
def test_dirty_assertions_fire(spark, key):
    assert E.queries()[key](spark, SF_SMALL).count() > 0
    clean = key[: -len("_dirty")]
    assert E.queries()[clean](spark, SF_SMALL).count() == 0
