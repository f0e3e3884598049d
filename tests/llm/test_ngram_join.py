import itertools
import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from marquee.llm import common, ngram_join
from marquee.llm.components import components


def brute(rows, k, num, den):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in t or ""))
        sets[d] = {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    uses = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            uses[x].append(d)
    common = Counter(p for own in uses.values() for p in itertools.combinations(own, 2))
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), c in common.items():
        if den * c >= num * (len(sets[a]) + len(sets[b]) - c):
            a, b = sorted((root(a), root(b)))
            up[b] = a
    return {d: (len(sets[d]), root(d)) for d in sets}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        words[i:i + 1] = rng.choice(([], ["new" + str(rng.random())], [words[i], "more"]))
    return words


@pytest.mark.parametrize(("k", "num", "den"), [(3, 90, 100), (5, 8, 10), (2, 6, 10)])
def test_as_brute_force(spark, monkeypatch, k, num, den):
    # Small row blocks, so that groups need several and the second round has work.
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "SECOND_BLOCK", 6)
    rng = random.Random(k)
    rows = []
    for _ in range(12):
        start = [f"w{rng.randrange(400)}" for _ in range(rng.choice((2, 5, 12, 40, 120)))]
        rows += [" ".join(edited(rng, start, rng.randrange(1 + len(start) // 9))) for _ in range(25)]
    rows = list(enumerate([*rows, "", "  ", "one", "One", "one two", "ONE\ttwo"]))
    rng.shuffle(rows)
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id bigint, text string"), k, num, den)
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == brute(rows, k, num, den)


def test_shared_passages_make_no_large_clusters(spark):
    # Every text holds half of one passage; only the edited copies among them are linked.
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for g in range(100):
        own = passage + [f"own{g}x{i}" for i in range(60)]
        rows += [" ".join(own), " ".join(edited(rng, own, 1))] if g % 10 == 0 else [" ".join(own)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    sets = {r["doc_id"]: r for r in ngram_join._sets(docs, 5, 8, 10).select("doc_id", "h", "n").collect()}
    one = spark.createDataFrame([(0, r["h"], d, r["n"]) for d, r in sets.items()],
                                "cluster bigint, h bigint, doc_id bigint, n bigint")
    got = ngram_join._refined(docs, one, 5, 8, 10).collect()
    members = defaultdict(set)
    for r in got:
        members[r["cluster"]].add(r["doc_id"])
    want = defaultdict(set)
    for d, (_, label) in brute(list(enumerate(rows)), 5, 8, 10).items():
        want[label].add(d)
    assert sorted(map(sorted, members.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)


def test_parts_suffice_for_every_pair_of_sizes():
    for num, den in ((9, 10), (8, 10), (6, 10)):
        for a in range(1, 400):
            for b in range(a, a * den // num + 1):
                shared = dict.fromkeys(ngram_join.instances(a, num, den)).keys() & ngram_join.instances(b, num, den)
                differ = (a + b) * (den - num) // (den + num)
                # A part more than the differing shingles, and the spare ones.
                assert not differ or max((parts - spare for _, parts, spare, _ in shared), default=0) > differ, (a, b)


def test_an_empty_set_signs_nothing():
    assert ngram_join.instances(0, 90, 100) == [] and ngram_join.signatures(np.zeros(0, np.uint64), 90, 100) == []


def test_shared_signatures_come_from_packed_buckets(spark, monkeypatch):
    # Only what several classes have becomes rows, copies count once, and no signature is one row of a shuffle.
    monkeypatch.setattr(ngram_join, "MERGED_SIGNS", 50)
    rng = random.Random(9)
    start = [f"w{i}" for i in range(80)]
    texts = [" ".join(edited(rng, start, rng.randrange(4))) for _ in range(30)]
    texts += [texts[0]] * 40 + [f"own{i} text" for i in range(20)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    sets = {ngram_join._identity(s)[0]: s for s in
            ngram_join.shingle_sets([(t or "").encode() for t in texts], 5) if len(s)}
    uses, least = defaultdict(set), {}
    for h, s in sets.items():
        for i, (_, few, sign) in enumerate(ngram_join.signatures(s, 8, 10)):
            least[h, i] = few
            for x in sign.tolist():
                uses[x & ((4 << 32) - 1)].add((h, i))
    want = {(h, 2 * least[h, i] + i, x, len(own)) for x, own in uses.items() if len(own) > 1 for h, i in own}
    dealt = ngram_join._dealt_signatures(docs, 5, 8, 10, 4)
    got = [tuple(r) for r in ngram_join._shared_signatures(dealt).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert dealt.count() <= 3 * 4


def test_signs_of_one_set_that_fall_together_lower_its_bound(spark, monkeypatch):
    sign = np.array([1, 1 + (1 << 40), 2, 3], dtype=np.uint64)
    monkeypatch.setattr(ngram_join, "signatures", lambda s, num, den: [(0, 3, sign)])
    text = "a b c d e f"
    run = ngram_join._dealt_signatures
    seen = {}

    class Docs:
        def mapInArrow(self, f, schema):
            import pyarrow as pa
            seen["rows"] = [r for b in f([pa.RecordBatch.from_pydict({"text": [text]})]) for r in b.to_pylist()]

    run(Docs(), 5, 8, 10, 1)
    assert [np.frombuffer(r["instance"], np.int16).tolist() for r in seen["rows"]] == [[4, 4, 4, 4]]


def test_shared_grams_come_from_packed_buckets(spark, monkeypatch):
    # Large clusters' n-grams are no rows of a shuffle; only those that several classes of a cluster hold become rows.
    monkeypatch.setattr(ngram_join, "RUN_CLASSES", 7)
    monkeypatch.setattr(ngram_join, "SHARED_ROWS", 50)
    rng = random.Random(12)
    start = [f"w{i}" for i in range(60)]
    texts = list(dict.fromkeys(" ".join(edited(rng, start, rng.randrange(1, 5))) for _ in range(40)))
    texts += [f"own{i} {i} text" for i in range(9)]
    sets = ngram_join.shingle_sets([t.encode() for t in texts], 5)
    rows = [(-i % 2, ngram_join._identity(s)[0], t) for i, (t, s) in enumerate(zip(texts, sets, strict=True))]
    uses, own = Counter(), {}
    for (cluster, h, _), s in zip(rows, sets, strict=True):
        key = ngram_join.mix(np.array([cluster]).view(np.uint64))
        own[h] = set((ngram_join.mix(s ^ key) & np.uint64((4 << 32) - 1)).tolist())
        uses.update(own[h])
    want = {h: {(g, uses[g]) for g in x if uses[g] > 1} for h, x in own.items()}
    asked = [*rows, (0, 5, texts[0]), (1, 6, None)]  # the last two don't hold the class they are asked for
    asked = spark.createDataFrame(asked, "cluster bigint, h bigint, text string").repartition(3)
    dealt = ngram_join._dealt_grams(asked, 5, 8, 10, 4)
    got = ngram_join._shared_grams(dealt).collect()
    classes = {(r["run"], r["place"]): r["h"] for r in got if r["uses"] is None}
    least = {r["h"]: r["least"] for r in got if r["uses"] is None}
    assert least == {h: -(-len(s) * 8 // 10) for (_, h, _), s in zip(rows, sets, strict=True)}
    found = {h: set() for h in classes.values()}
    for r in got:
        if r["uses"] is not None:
            found[classes[r["run"], r["place"]]].add((r["g"], r["uses"]))
    assert found == want and any(want.values())
    assert dealt.count() <= (len(texts) // 7 + 3) * 5 < sum(map(len, sets)) // 10


def test_overlaps():
    sets = [np.array(x, dtype=np.uint64) for x in ([1, 2, 3], [2, 3, 4, 5], [9])]
    assert ngram_join.overlaps(sets).tolist() == [[2, 2, 0], [2, 2, 0], [0, 0, 0]]


def test_odd_tables(spark, odd_docs, no_docs):
    got = sorted((r[0] or -1, r[1], r[2] or -1) for r in ngram_join.join(odd_docs).collect())
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 0, 4), (5, 1, 5), (6, 10, 6), (7, 10, 6), (8, 196, 8),
                          (9, 197, 8), (9, 197, 8), (10, 196, 8), (11, 1, 11), (11, 2, 11), (-1, 196, -1), (12, 1, 12)])
    assert ngram_join.join(no_docs).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(500, 560)] + [(7, 7)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            up[b] = a
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in list(up)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_classes_hold_the_sets_of_a_chunk_only(monkeypatch):
    texts = [None, "", "a b c d", *[f"w{i} x y z" for i in range(50)]]
    whole = [ngram_join._identity(s)[0] if len(s) else None
             for s in ngram_join.shingle_sets([(t or "").encode() for t in texts], 3)]
    seen, sets = [], ngram_join.shingle_sets
    monkeypatch.setattr(ngram_join, "SET_CHUNK", 64)
    monkeypatch.setattr(ngram_join, "shingle_sets", lambda batch, k: seen.append(sum(map(len, batch))) or sets(batch, k))
    common.made_once("codec", SimpleNamespace(value=0), lambda v: [v])
    assert ngram_join._classes(pa.array(texts), 3).to_pylist() == whole
    assert len(seen) > 5 and max(seen) <= 2 * 64 and not common._made
