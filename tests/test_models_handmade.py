"""Hand-made landings for the model-level traps."""

import pytest

from marquee.plans import analyses as A
from marquee.plans.models import Catalogue
from marquee.sources.landing import all_string_schema

COLS = ("show_id", "type", "title", "director", "cast", "country", "date_added",
        "release_year", "rating", "duration", "listed_in", "description")


def landing(spark, rows):
    full = [tuple(r.get(c) for c in COLS) for r in rows]
    return spark.createDataFrame(full, all_string_schema())


ROWS = [
    # leading comma: first real country has position 2, no primary country
    dict(show_id="a", type="Movie", title="A", country=", France", cast="P1, P2, P3, P4",
         date_added=" March 5, 2019", release_year="2017", rating="PG", duration="93 MIN",
         listed_in="Dramas, TV Dramas"),
    # repeated token in one cell; director only (cast_size 0, not NULL)
    dict(show_id=" b ", type="TV Show", title="B", country="Spain, Spain, France",
         director="D1, D2", date_added="December 31, 2020", release_year="2019.5",
         rating="XX", duration="1 Season", listed_in="Anime Series"),
    # no people at all, blank cells, trailing comma
    dict(show_id="c", type="Movie", title="C", country="France, ", cast="  ",
         date_added="Mar 5, 2019", release_year="2001", duration="min"),
    # NULL key: dropped by staging
    dict(show_id=None, type="Movie", title="X"),
]


@pytest.fixture()
def cat(spark):
    return Catalogue(landing(spark, ROWS))


@pytest.fixture(params=[True, False], ids=["narrow", "grouped"])
def both(spark, request):
    return Catalogue(landing(spark, ROWS), unique_keys=request.param)


def test_staging_traps(cat):
    s = {r["show_id"]: r for r in cat.staging.collect()}
    assert set(s) == {"a", "b", "c"}                       # NULL key dropped, key trimmed
    assert str(s["a"]["date_added"]) == "2019-03-05 00:00:00"  # leading space tolerated
    assert s["c"]["date_added"] is None                    # abbreviated month is not parsed
    assert s["b"]["release_year"] == 2020                  # '2019.5' rounds half away, as cast
    assert s["a"]["duration_minutes"] == 93 and s["a"]["seasons"] is None
    assert s["b"]["seasons"] == 1 and s["b"]["duration_minutes"] is None
    assert s["c"]["duration_minutes"] is None              # 'min' without digits
    assert s["b"]["audience_band"] is None and s["a"]["audience_band"] == "Older kids"
    assert s["c"]["cast_raw"] is None                      # blank -> NULL
    assert s["a"]["years_release_to_platform"] == 2


def test_bridges_and_mart(both):
    c = sorted((r["show_id"], r["country"], r["country_position"], r["is_primary_country"],
                r["country_count"]) for r in both.countries.collect())
    assert c == [("a", "France", 2, False, 1),
                 ("b", "France", 3, False, 3), ("b", "Spain", 1, True, 3),
                 ("b", "Spain", 2, False, 3),
                 ("c", "France", 1, True, 1)]
    m = {r["show_id"]: r for r in both.mart.collect()}
    assert m["a"]["primary_country"] is None and m["a"]["all_countries"] == "France"
    assert m["b"]["all_countries"] == "Spain, Spain, France"
    assert m["a"]["cast_size"] == 4 and m["a"]["director_count"] == 0
    assert m["b"]["cast_size"] == 0 and m["b"]["directors"] == "D1, D2"
    assert m["c"]["cast_size"] is None and m["c"]["directors"] is None
    assert m["a"]["all_genres"] == "Dramas, Dramas" and m["a"]["genre_count"] == 2
    assert m["c"]["completeness_score"] == 1 and m["c"]["missing_cast"]
    top = {r["person_name"]: r["is_top_billed"] for r in both.people.collect()}
    assert top["P3"] and not top["P4"] and not top["D1"]


def test_analysis_traps(both):
    # two labels of one normalised genre count twice (tags, not titles)
    g = {r["genre"]: r["titles"] for r in A.q05_genre_profile(both).collect()}
    assert g["Dramas"] == 2
    # a repeated token pairs with the other country once per occurrence
    p = {(r["country_a"], r["country_b"]): r["co_productions"]
         for r in A.q10_co_production(both, min_pairs=1).collect()}
    assert p == {("France", "Spain"): 2}
    # rounding is on the binary double: 1 of 3 titles -> 33.3
    q2 = {r["title_type"]: r for r in A.q02_completeness(both).collect()}
    assert q2["Movie"]["titles"] == 2
