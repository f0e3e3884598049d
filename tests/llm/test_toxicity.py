import random

from marquee.llm import toxicity
from marquee.llm.queries import op7_toxicity


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = "doc_id % 5 = 0"
    got = toxicity.classify(docs, labels.filter(f"not ({held})")).select("doc_id", "toxic")
    pairs = got.join(labels.filter(held).select("doc_id", labels.toxic.alias("truth")), "doc_id").collect()
    caught = sum(r["toxic"] for r in pairs if r["truth"] == 1)
    false = sum(r["toxic"] for r in pairs if r["truth"] == 0)
    toxic = sum(r["truth"] == 1 for r in pairs)
    assert toxic > 50
    assert caught >= 0.9 * toxic
    assert false <= 0.02 * (len(pairs) - toxic)


def test_later_links_use_earlier_ones(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(300):
        first = rng.random() < 0.5
        # The second category shows only where the first does, and partly in its own word.
        second = first and rng.random() < 0.8
        rows.append((" ".join(["bad" if first else "good", "worse" if second else "fine", f"w{rng.randrange(50)}"]), int(first), int(second)))
    chain = toxicity.fit(spark.createDataFrame(rows, "text string, a int, b int"), ["a", "b"])
    assert len(chain.models[1].extra) == 1 and chain.models[1].extra[0] != 0
    p = chain.predict(["bad worse", "good fine", "", "unseen"])
    assert p[0, 0] > 0.5 and p[0, 1] > 0.5 and p[1, 0] < 0.5 and p[1, 1] < 0.5
    assert (p[2] == p[3]).all()


def test_odd_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 1), (99, 1, 1), (6, None, 1), (None, 1, 0), (3, 0, 1)],
                                   "doc_id bigint, quality int, toxic int")
    docs = odd_docs.withColumnRenamed("h", "toxic")  # a name that clashes with an output
    got = toxicity.classify(docs, labels)
    assert got.count() == odd_docs.count()
    assert set(got.columns) == set(docs.columns) | {"p_low_quality", "low_quality", "p_toxic"}
    assert toxicity.classify(docs, labels.limit(0)).filter("p_toxic > 0.001 or toxic").count() == 0
    assert toxicity.classify(no_docs, labels).count() == 0


def test_query_covers_every_document(spark):
    got = op7_toxicity(spark, "/root/testdata/sf0.001")
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert got.filter("p_toxic is null or p_toxic < 0 or p_toxic > 1").count() == 0
