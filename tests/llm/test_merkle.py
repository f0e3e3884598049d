import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marquee.llm import merkle, queries
from tests.compare import compare

SF = "/root/testdata/sf0.001"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(r):
    return sha("".join("-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in merkle.LEAF_COLUMNS))


def tree(nodes, fanout):
    """The top, and for each node its siblings left and right, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            first = i // fanout * fanout
            paths[k].append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + fanout])))
        nodes = [sha("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], paths


def brute(rows, fanout=2):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops = [tree([k[2] for k, _ in sorted(groups[g], key=lambda x: x[0])], fanout) for g in names]
    root, above = tree([t for t, _ in tops], fanout)
    out = []
    for g, (top, paths), up in zip(names, tops, above, strict=True):
        for place, (key, r) in enumerate(sorted(groups[g], key=lambda x: x[0])):
            out.append((r["doc_id"], g, key[2], place, tuple(paths[place] + up), top, root))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["group"], r["leaf"], r["place"], tuple(map(tuple, r["path"])), r["subroot"], r["root"])
                   for r in df.collect()), key=str)


@pytest.mark.parametrize(("fanout", "levels"), [(2, 2), (3, 2), (2, 10)])
def test_as_brute_force(spark, fanout, levels):
    rng = random.Random(fanout)
    rows = [(k, rng.choice(["some text", "", None]), rng.choice(["en", "en", "en", "de", "日本", None]), "s", k) for k in range(150)]
    docs = spark.createDataFrame([*rows, (1000, "t", "lone", "s", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert found(merkle.manifest(docs, fanout=fanout, levels=levels)) == brute(docs.collect(), fanout)


def test_every_path_leads_to_the_root(spark):
    got = merkle.manifest(spark.read.parquet(f"{SF}/documents.parquet"), levels=3)
    assert got.filter(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert got.select("root").distinct().count() == 1


def test_query_as_sql_and_tampering_shows(spark):
    ok, message = compare(queries.op12_merkle_manifest(spark, SF), queries.ORACLE["op12_merkle_manifest"], SF)
    assert ok, message
    for r in queries.op12_merkle_manifest(spark, SF).collect():
        assert r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 != 0)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_rows(spark, n):
    docs = spark.createDataFrame([(k, "t", "en", "s", 1) for k in range(n)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = found(merkle.manifest(docs))
    assert got == brute(docs.collect())
    assert len(got[0][4]) == n - 1


def test_odd_tables(spark, odd_docs, no_docs, scratch):
    assert found(merkle.manifest(odd_docs)) == brute(odd_docs.collect())
    assert merkle.manifest(no_docs).count() == 0
    clash = odd_docs.withColumnsRenamed({"n_words": "leaf", "h": "path", "findings": "place"}).withColumn("block", F.lit(1))
    assert found(merkle.manifest(clash)) == brute(odd_docs.collect())
    clash.write.parquet(scratch + "/sf/documents.parquet")
    got = queries.op12_merkle_manifest(spark, scratch + "/sf").collect()
    # Without an id or a count nothing is tampered with.
    assert all(r["verified"] for r in got if r["doc_id"] in (None, 1)) and len(got) == 15
