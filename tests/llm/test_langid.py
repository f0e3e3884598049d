import random
import re
import time
from types import SimpleNamespace

import numpy as np
import duckdb

from marquee.llm import common, langid
from marquee.llm.queries import op2_language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in op2_language_id(spark, SF).collect()}
    truth = duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet' where lang is not null").fetchall()
    held = [(lang, got[d]["lang_pred"]) for d, lang in truth if got[d]["held_out"]]
    assert len(held) > 100
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_unseen_words_fall_back_to_shorter_ngrams(spark):
    rows = [("en", "the thing is that"), ("fr", "le chat est là")] * 3
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    p = langid.Predictor(model)
    assert model.langs == ["en", "fr"]
    assert p.predict(["thing", "things", "chats", "123", "", "zzz"])[0][:5] == ["en", "en", "fr", "und", "und"]
    assert model.unseen("日").tolist() == [0.0, 0.0]


def test_the_label_is_no_input(spark):
    rows = [(i, "the thing is that", "en") for i in range(20)] + [(20 + i, "le chat est là", "fr") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    a = {r["doc_id"]: r["lang_pred"] for r in langid.identify(df).collect()}
    assert a == {i: "en" if i < 20 else "fr" for i in range(40)}


def test_odd_tables(spark, odd_docs, no_docs):
    got = langid.identify(odd_docs)
    assert got.count() == odd_docs.count()
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got.collect()}
    assert by[1] == by[2] == by[4] == by[5] == ("und", 0.0)
    assert langid.identify(no_docs).count() == 0
    unlabelled = odd_docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r["lang_pred"] for r in langid.identify(unlabelled).collect()} == {"und"}


def test_numeric_signs_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "\u00b2 \u00bd \u2462 \u2167 12 _"), (2, "\u00e9t\u00e9 x\u00b2")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(
        docs, langid.Model(["fr"], {"x": np.array([1.0])})).collect()}
    assert got == {1: ("und", 0.0), 2: ("fr", 1.0)}
    assert langid.words("x\u00b2 \u00e9t\u00e9 \u4e2d\u6587") == ["x", "\u00e9t\u00e9", "\u4e2d\u6587"]


def test_words_are_found_at_the_speed_of_a_plain_scan():
    text = "the quick brown fox, \u00e9t\u00e9 12 times " * 20_000

    def seconds(scan):
        begun = time.process_time()
        scan(text)
        return time.process_time() - begun

    assert min(seconds(langid.words) for _ in range(3)) < 5 * min(seconds(re.compile(r"[^\W\d_]+").findall) for _ in range(3))


def test_runs_are_cut_at_numeric_signs_only():
    rng = random.Random(3)
    signs = [*"ab\u00b2\u2167\u00bd5_ \u00e9\u4e03\u0661\U00010b31x", *(chr(rng.randrange(0x20, 0xD800)) for _ in range(60))]
    for _ in range(2000):
        text = "".join(rng.choice(signs) for _ in range(30))
        assert langid.words(text) == langid._LETTERS.findall(text.lower())


def test_a_worker_keeps_only_what_it_made_last():
    a, b = object(), object()
    common.made_once("one", SimpleNamespace(value=a), lambda v: [v])
    common.made_once("other", SimpleNamespace(value=b), lambda v: [v])
    assert list(common._made) == ["other"]
    common.drop_made()
    assert not common._made
