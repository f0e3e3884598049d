import random
import re

import pytest
from pyspark.sql import functions as F

from marquee.llm import licenses, queries
from tests.compare import compare

SF = "/root/testdata/sf0.001"
NOTICE = " ".join(licenses.PARAGRAPHS["isc"][0].split())


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, lines, paragraphs, num, den):
    """All templates against all blocks: (label, kind, first word, shared, size)."""
    found, at, para, start = [], 0, [], 0

    def held(kind, own, first):
        for label, ts in (lines if kind == "line" else paragraphs).items():
            for t in ts:
                want = set(words(t))
                if (n := len(want & set(own))) * den >= num * len(want) and want:
                    found.append((label, first, n, len(want)))

    for line in [*(text or "").split("\n"), ""]:
        own = words(line)
        if own:
            start = start if para else at
            held("line", own, at)
            para += own
            at += len(own)
        elif para:
            held("paragraph", para, start)
            para = []
    return sorted(found)


@pytest.mark.parametrize(("num", "den"), [(8, 10), (5, 10), (1, 1)])
def test_join_as_all_templates_against_all_blocks(spark, num, den):
    rng = random.Random(num)
    vocabulary = [f"w{k}" for k in range(40)]
    draw = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    lines = {f"l{k}": [draw(rng.randrange(1, 8))] for k in range(8)}
    paragraphs = {f"p{k}": [draw(rng.randrange(8, 25))] for k in range(6)}
    pieces = [t for ts in (*lines.values(), *paragraphs.values()) for t in ts]
    texts = []
    for _ in range(400):
        rows = []
        for _ in range(rng.randrange(5)):
            own = rng.choice(pieces).split() if rng.random() < 0.7 else draw(rng.randrange(30)).split()
            own = [w for w in own if rng.random() > 0.1] + draw(rng.randrange(3)).split()
            rng.shuffle(own)
            rows.append(" ".join(own))
        texts.append(rng.choice(["\n", "\n\n", "\n \n"]).join(rows))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    templates = licenses.Templates(lines, paragraphs, num, den)
    got = {r["doc_id"]: sorted((b["label"], b["first_word"], b["shared"], b["size"]) for b in r["blocks"])
           for r in licenses.find(docs, templates=templates).collect()}
    assert got == {k: brute(t, lines, paragraphs, num, den) for k, t in enumerate(texts)}
    assert sum(map(len, got.values())) > 100


def test_query_as_sql(spark):
    ok, message = compare(queries.op13_license_scan(spark, SF), queries.ORACLE["op13_license_scan"], SF)
    assert ok, message


@pytest.mark.parametrize(("text", "base", "every", "least"), [
    ("Released under the MIT License.", "mit", "mit", 1.0),
    ("the MIT\n--license-- mit LICENSE", "mit", "mit", 1.0),
    ("Licensed under CC BY-NC 4.0.", "", "cc-by-nc", 1.0),
    ("a permit license, apache 2 license", "", "", 0.0),
    (NOTICE, "", "isc", 1.0),
    (NOTICE.replace("purpose", "end").replace(" software", "\nprogram"), "", "isc", 0.8),
    ("General Public License of the Apache License", "apache,gpl", "apache,gpl", 1.0),
])
def test_known_notices(spark, text, base, every, least):
    got = licenses.find(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).select(
        licenses.labels(F.col("places")), licenses.labels(F.col("places"), F.filter("blocks", lambda b: b["closest"])),
        licenses.score(F.col("places"), F.col("blocks"))).first()
    assert (got[0], got[1]) == (base, every) and least <= got[2] <= 1


def test_odd_tables(spark, odd_docs, no_docs, scratch):
    clash = odd_docs.withColumnsRenamed({"h": "places", "findings": "blocks"})
    got = licenses.find(clash).collect()
    assert sorted((r["doc_id"] or -1, r["n_words"]) for r in got) == sorted(
        (r["doc_id"] or -1, len(words(r["text"]))) for r in odd_docs.collect())
    assert all(r["places"] == [] and r["blocks"] == [] for r in got) and "source" in got[0]
    assert licenses.find(no_docs).count() == 0
    odd_docs.write.parquet(scratch + "/sf/documents.parquet")
    assert queries.op13_license_scan(spark, scratch + "/sf").count() == 15


def test_templates_are_bounded():
    with pytest.raises(ValueError, match="not broadcast"):
        licenses.Templates({"x": [" ".join(f"{k:0100d}" for k in range(50_000))]})
