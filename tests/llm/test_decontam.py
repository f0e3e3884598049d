import random
import re

from marquee.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(text, items, window=10):
    words = WORD.findall(lower(text))
    hit, found = set(), set()
    for item_id, t in items:
        own = WORD.findall(lower(t))
        for i in range(max(1, len(own) - window + 1)) if own else ():
            w = own[i:i + window]
            for j in range(len(words) - len(w) + 1):
                if words[j:j + len(w)] == w:
                    hit.update(range(j, j + len(w)))
                    if item_id is not None:
                        found.add(item_id)
    return len(words), sorted(hit), sorted(found)


def test_as_brute_force(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b", "Cé", "日", "x1", "the"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 2, 9, 10, 11, 14])))) for i in range(14)]
    items += [(14, None), (None, "only here"), (3, "b b b b b")]
    docs = [(i, rng.choice([" ", ", ", "-\x00"]).join(word() for _ in range(rng.randint(0, 120)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "xx only   HERE yy"), (103, items[5][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for size in (1 << 18, 120):  # one block of items, several blocks
        got = decontam.decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), bench,
                                     block_bytes=size).collect()
        assert len(got) == len(docs)
        for r in got:
            n, hit, found = brute(r["text"], items)
            assert (r["n_words"], sorted(r["hit_words"]), sorted(r["items"])) == (n, hit, found), r["doc_id"]
            assert r["contaminated"] == bool(hit)


def test_spans_lie_on_the_original(spark):
    bench = spark.createDataFrame([(1, "alpha beta")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "éé ALPHA--beta, alpha\nbeta 🙂 alpha x beta")], "doc_id bigint, text string")
    r = decontam.decontaminate(docs, bench).first()
    assert [r["text"][s["start"]:s["end"]] for s in r["spans"]] == ["ALPHA--beta, alpha\nbeta"]


def test_blocks_don_t_show(spark):
    """Spans that two blocks' words make together, and items that share a text, come out as from one block."""
    items = [(1, "alpha beta"), (2, "beta gamma"), (3, "gamma delta x"), (4, "alpha beta"), (None, "delta x y"), (5, " ")]
    docs = [(1, "é Alpha, beta GAMMA delta x--y, z"), (2, "é Alpha, beta GAMMA delta x--y, z"), (3, None), (4, "beta"), (5, "")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    one, many = ([r.asDict(True) for r in decontam.decontaminate(frame, bench, block_bytes=size).orderBy("doc_id").collect()]
                 for size in (1 << 20, 24))
    assert one == many
    assert one[0]["items"] == [1, 2, 3, 4] and len(one[0]["spans"]) == 1
    assert one[0]["text"][one[0]["spans"][0]["start"]:one[0]["spans"][0]["end"]] == "Alpha, beta GAMMA delta x--y"


def test_blocks_are_bounded(spark):
    own = spark.createDataFrame([(i, f"text {i % 50}") for i in range(500)], "i bigint, t string")
    blocks = decontam.item_blocks(own, 400)
    assert sorted(t for b in blocks for _, t in b) == sorted(f"text {i}" for i in range(50))
    assert sorted(i for b in blocks for ids, _ in b for i in ids) == list(range(500))
    assert all(sum(len(t) + 8 * len(ids) for ids, t in b) <= 400 for b in blocks)


def test_odd_tables(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "quick brown fox")], "item_id bigint, text string")
    got = decontam.decontaminate(odd_docs, bench)
    assert got.count() == odd_docs.count()
    assert {r["doc_id"] for r in got.filter("contaminated").collect()} == {6, 7}
    assert decontam.decontaminate(no_docs, bench).count() == 0
    assert decontam.decontaminate(odd_docs, bench.limit(0)).filter("contaminated").count() == 0
