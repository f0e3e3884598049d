import random
import time

import numpy as np
import pytest

from marquee.llm import html_blocks as H
from marquee.llm.queries import op5_html_blocks

PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";x<1</script></head><body>'
        '<nav><ul><li><a href="/a">Home</a><li><a href=/b>News</a></ul></nav><!-- ad <p> --><div class="ad">Buy now</div>'
        '<article><h1>Head &amp; line</h1><p><b>One\n two&nbsp;<br>three<p>A&#233; b<i>c</i>d.</p></article>'
        '<footer>&copy; us</footer>')


def test_blocks():
    got = [(t, n) for _, t, n in H.blocks(PAGE)]
    assert [t for t, _ in got] == ["T", "Home", "News", "Buy now", "Head & line", "One two three", "Aé bcd.", "© us"]
    assert [n for _, n in got][:3] == [0, 4, 4]
    assert H.blocks(PAGE)[6][0][-2:] == ("article", "p")
    assert H.blocks("") == [] and H.blocks("<p") == [(("p",), "", 0)][:0] or H.blocks("<p")[0][1] == "<p"


def test_stray_quotes_lose_no_text():
    got = H.blocks("<article><p data-x=it's>Lost text here.</p><p>Second don't stop</p><p a\"b c='>'>Third</p><p x=\"y>Fourth</p>")
    assert [t for _, t, _ in got] == ["Lost text here.", "Second don't stop", "Third", "Fourth"]
    assert [t for _, t, _ in H.blocks('<p class = "a>b" id=c/>One<p x=>Two<P\n/>Three</p x="y">')] == ["One", "Two", "Three"]
    assert H.blocks('<p class = "a>b" id=c>One')[0][0] == ("p", ".a>b", ".c")


@pytest.mark.parametrize("piece", ['<a "', '<a x="', "<a x='>", "<p", "<!", "<script", "<a b ", "</", "<!--", "<script>", "<a  =  "])
def test_pages_are_read_in_linear_time(piece):
    started = time.perf_counter()
    H.blocks(piece * 50_000)
    assert time.perf_counter() - started < 5


@pytest.fixture(scope="module")
def labeller():
    return H.train(["alpha", "beta", "gamma", "delta", "word", "other", "thing"])


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    pages = [rng.normal(size=(n, H.DIMS)) for n in (3, 5)]
    labels = [np.array([1.0, 0, 1]), np.array([0.0, 1, 1, 0, 1])]

    def loss(model):
        return -sum((y * np.log(s) + (1 - y) * np.log(1 - s)).sum() for s, y in zip(model.predict(pages), labels, strict=True)) / 8

    model = H.Labeller(3)
    x, there = model._padded(pages)
    y = np.zeros(x.shape[:2])
    for k, own in enumerate(labels):
        y[:len(own), k] = own
    _, kept, kept_back, share = model._run(x, there)
    wrong = (share - y) * there[:, :, 0] / there.sum()
    slope = wrong[:, :, None] * model.out
    gw, _ = model.ahead.backward(x, there, kept, slope[:, :, :H.HIDDEN])
    bw, _ = model.back.backward(x[::-1], there[::-1], kept_back, slope[::-1, :, H.HIDDEN:2 * H.HIDDEN])
    for lstm, grad in ((model.ahead, gw), (model.back, bw)):
        for at in ((0, 0), (H.DIMS, 5), (7, 40), (H.DIMS + 3, 60)):
            old = lstm.w[at]
            lstm.w[at] = old + 1e-5
            up = loss(model)
            lstm.w[at] = old - 1e-5
            down = loss(model)
            lstm.w[at] = old
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-6


def test_held_out_accuracy(labeller):
    rng, right, every = random.Random(123), 0, 0
    for _ in range(150):
        page, labels = H.training_page(rng, ["new", "words", "never", "seen"])
        found = H.blocks(page)
        if len(found) == len(labels):
            right += int(((labeller.predict([H.vectors(found)])[0] >= 0.5) == np.array(labels)).sum())
            every += len(labels)
    assert right >= 0.97 * every


def test_text(labeller):
    assert H.extract_text(labeller, [PAGE, "", PAGE]) == ["Head & line One two three Aé bcd.", "", "Head & line One two three Aé bcd."]


def test_query_and_odd_pages(spark):
    got = op5_html_blocks(spark, "/root/testdata/sf0.001")
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    right = 0
    for r in got.collect():
        inside = [t for path, t, _ in H.blocks(pages[r["page_id"]]) if "article" in path]
        right += r["text"] == " ".join(inside)
        assert r["n_chars"] == len(r["text"])
    assert right >= 0.98 * len(pages)
    odd = spark.createDataFrame([(1, None, "x", "old"), (2, "", None, None), (2, "", None, None), (3, "<p>" * 3000 + "a" * 200_000, None, None),
                                 (None, "plain", None, None)], "page_id bigint, html string, url string, text string")
    out = H.extract(odd)
    assert out.columns == odd.columns
    texts = [r["text"] for r in out.orderBy("page_id").collect()]
    assert len(texts) == 5 and texts[1] == texts[2] == texts[3] == ""
    assert H.extract(odd.limit(0)).count() == 0
