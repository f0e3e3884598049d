"""Hand-made cases for the scalar cleaning functions."""


from marquee.functions import (
    audience_band, blank_to_null, clean, normalise_genre, present_tokens, token_parts,
    parse_month_day_year, pct, round_half_away, unit_measure,
)


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_trim_unicode_spaces_not_tab(spark):
    assert one(spark, clean("x"), "\u00a0 a \u3000") == "a"
    assert one(spark, clean("x"), "\u202fb\u2009") == "b"
    assert one(spark, clean("x"), "\tc ") == "\tc"


def test_blank_to_null(spark):
    assert one(spark, blank_to_null("x"), "   ") is None
    assert one(spark, blank_to_null("x"), None) is None
    assert one(spark, blank_to_null("x"), " v ") == "v"


def test_round_half_away_binary(spark):
    s = "x double"
    assert one(spark, round_half_away("x", 2), 1.005, s) == 1.0
    assert one(spark, round_half_away("x", 2), 0.285, s) == 0.28
    assert one(spark, round_half_away("x", 0), 2.5, s) == 3.0
    assert one(spark, round_half_away("x", 0), -2.5, s) == -3.0
    r = one(spark, round_half_away("x", 0), -0.3, s)
    assert r == 0.0 and str(r) == "-0.0"
    assert one(spark, round_half_away("x", 1), None, s) is None


def test_pct_is_double(spark):
    df = spark.createDataFrame([(1, 3)], "a int, b int").select(pct("a", "b", 1).alias("p"))
    assert df.schema["p"].dataType.typeName() == "double"
    assert df.first()["p"] == 33.3


def test_dates(spark):
    p = parse_month_day_year("x")
    assert str(one(spark, p, " March 5, 2019")) == "2019-03-05 00:00:00"
    assert str(one(spark, p, "March 05, 2019")) == "2019-03-05 00:00:00"
    assert one(spark, p, "Mar 5, 2019") is None
    assert one(spark, p, "February 30, 2019") is None
    assert one(spark, p, "2019-03-15") is None
    assert one(spark, p, None) is None


def test_dates_whitespace_and_year_width(spark):
    p = parse_month_day_year("x")
    assert str(one(spark, p, "March  5, 2019")) == "2019-03-05 00:00:00"   # space run
    assert str(one(spark, p, "March\t5,  2019")) == "2019-03-05 00:00:00"  # tab, two spaces
    assert str(one(spark, p, "March 5, 19")) == "0019-03-05 00:00:00"      # short year
    for bad in ("March 5,2019", "March5, 2019", "March 5, -2019", "March 5, 12019",
                "March 005, 2019", "March\u00a05, 2019", "March 5, 2019."):
        assert one(spark, p, bad) is None, bad


def test_to_int_reads_decimals_like_the_reference(spark):
    from marquee.functions import to_int
    cases = {"2019": 2019, "+2019": 2019, "2019.0": 2019, "2019.5": 2020, "-2.5": -3,
             "1e3": 1000, ".5": 1, "0.49999999999": 0, "2019.49999999999": 2019,
             "\u0968\u0966\u0967\u096f": None, "0x10": None, "2147483648": None, "n/a": None, "20 19": None, "": None}
    for text, want in cases.items():
        assert one(spark, to_int("x"), text) == want, text


def test_unit_measure(spark):
    assert one(spark, unit_measure("x", "min"), "93 MIN") == 93
    assert one(spark, unit_measure("x", "season"), "1 Season") == 1
    assert one(spark, unit_measure("x", "season"), "4 Seasons") == 4
    assert one(spark, unit_measure("x", "min"), "min") is None
    assert one(spark, unit_measure("x", "min"), "2 parts") is None


def test_bands_and_genres(spark):
    assert one(spark, audience_band("x"), " TV-Y7-FV ") == "Older kids"
    assert one(spark, audience_band("x"), "UR") == "Unrated"
    assert one(spark, audience_band("x"), "XX") is None
    assert one(spark, audience_band("x"), None) is None
    assert one(spark, normalise_genre("x"), "Kids' TV") == "Kids"
    assert one(spark, normalise_genre("x"), "Anime Series") == "Anime Series"


def test_tokens_positions_from_unfiltered_list(spark):
    parts = one(spark, token_parts("x"), ", France,, Spain , ")
    present = [(i + 1, t) for i, t in enumerate(parts) if t]
    assert present == [(2, "France"), (4, "Spain")]
    assert one(spark, present_tokens(token_parts("x")), "A, A") == ["A", "A"]


def test_token_parts_trimmed_with_blank_positions(spark):
    parts = one(spark, token_parts("x"), "\u00a0, France ,,\u3000Spain , ")
    assert parts == ["", "France", "", "Spain", ""]
    assert one(spark, present_tokens(token_parts("x")), ", a b ,c") == ["a b", "c"]
    assert one(spark, token_parts("x"), None) == []
    assert one(spark, token_parts("x", strict=False), "a , ") == ["a ", " "]
    assert one(spark, token_parts("x"), "\ta ,b") == ["\ta", "b"]


def test_space_set_matches_reference_trim(spark):
    """Exactly the 17 Unicode space separators are trimmed; tab, newlines,
    U+180E, line/paragraph separators and zero-width characters are kept,
    both by ``clean`` and inside ``token_parts`` (regex \\p{Zs})."""
    import unicodedata
    from marquee.functions import SPACE_SEPARATORS
    zs = {chr(i) for i in range(0x110000) if unicodedata.category(chr(i)) == "Zs"}
    assert set(SPACE_SEPARATORS) == zs and len(zs) == 17
    kept = ["\t", "\n", "\u180e", "\u2028", "\u200b", "\ufeff"]
    for ch in kept:
        assert one(spark, clean("x"), ch + "a" + ch) == ch + "a" + ch
        assert one(spark, token_parts("x"), "b," + ch + "a") == ["b", ch + "a"]
    for ch in sorted(zs):
        assert one(spark, clean("x"), ch + "a" + ch) == "a"
        assert one(spark, token_parts("x"), "b" + ch + "," + ch + "a") == ["b", "a"]


def test_cluster_conf_sizes_from_input():
    from marquee.session import cluster_conf
    big = cluster_conf(100 * 2 ** 40, executors=1000, cores_per_executor=8)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2 ** 40 // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(2 ** 20, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 16  # at least 2x the cores
