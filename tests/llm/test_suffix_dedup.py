import random

import numpy as np
import pytest

from marquee.llm import suffix_dedup
from marquee.llm.queries import op3_suffix_dedup


def brute(rows, length):
    first, out = {}, {}
    for d, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i:i + length], d)
    for d, t in rows:
        b = (t or "").encode()
        cover = np.zeros(len(b) + 1, dtype=int)
        for i in range(len(b) - length + 1 if d is not None else 0):
            if first[b[i:i + length]] < d:
                cover[i] += 1
                cover[i + length] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))))
        spans = list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
        out.setdefault(d, []).append((len(b), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return {d: sorted(v) for d, v in out.items()}


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(
            (r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])))
    return {d: sorted(v) for d, v in out.items()}


@pytest.mark.parametrize("length", [50, 24])
def test_as_brute_force(spark, monkeypatch, length):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 64)  # several suffix blocks
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 900)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 2000)
    rng = random.Random(length)
    passages = ["".join(rng.choices("abé ", k=rng.randint(20, 160))) for _ in range(12)]
    rows = []
    for i in range(90):
        rows.append((i, "".join(rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices("abcdefgh ", k=rng.randint(0, 60)))
                                for _ in range(rng.randint(0, 6)))))
    rows += [(200, "x" * 700), (201, "x" * 300), (202, "ab" * 400), (203, None), (204, ""), (205, "short"),
             (None, rows[3][1]), (206, rows[5][1]), (206, rows[5][1]), (206, rows[6][1]), (-4, passages[0])]
    rng.shuffle(rows)
    got = found(suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), length=length))
    assert got == brute(rows, length)


def test_suffix_order_for_any_placement():
    rng = random.Random(4)
    contents = list({"".join(rng.choices("ab", k=rng.randint(30, 90))).encode() for _ in range(60)})
    windows = np.array([len(c) - 29 for c in contents])
    buckets = np.zeros(len(contents), dtype=np.uint64)  # no gram is found: runs are placed as they come
    s = suffix_dedup.Suffixes(contents, windows, buckets, 30)
    s.run = np.repeat(np.arange(len(contents)), windows)
    docs = np.array([rng.randrange(1000) for _ in contents])
    got = s.smallest(docs)
    least, every = {}, []
    for c, d in zip(contents, docs.tolist(), strict=True):
        for i in range(len(c) - 29):
            every.append(c[i:i + 30])
            least[c[i:i + 30]] = min(d, least.get(c[i:i + 30], 1000))
    assert got.tolist() == [least[w] for w in every]


def test_odd_tables(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found(suffix_dedup.dedup(odd_docs)) == brute(rows, 50)
    assert suffix_dedup.dedup(no_docs).count() == 0


def test_query(spark):
    got = op3_suffix_dedup(spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows, 50)
    for r in got.collect():
        n, spans, _ = want[r["doc_id"]][0]
        assert (r["n_bytes"], r["n_spans"], r["n_removed"]) == (n, len(spans), sum(b - a for a, b in spans))


def test_hot_bucket_is_split(spark, monkeypatch):
    """One line in every document, different surroundings: no bucket holds them all."""
    real = suffix_dedup._window_minima

    def bounded(runs_of, windows, docs, length):
        total = {}
        for bucket, content in runs_of:
            total[bucket] = total.get(bucket, 0) + len(content)
        if max(total.values()) > 8000:
            raise ValueError("a bucket isn't split")
        return real(runs_of, windows, docs, length)

    monkeypatch.setattr(suffix_dedup, "_window_minima", bounded)
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 4000)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 6000)
    rng = random.Random(9)
    own = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=90))
    line = "this one line stands in each document, between words of its own."
    rows = [(i, own() + line + own()) for i in range(400)]
    rows += [(500 + i, rows[i][1][20:] + own()) for i in range(0, 400, 40)]  # copies that reach past the line
    got = found(suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert got == brute(rows, 50)
