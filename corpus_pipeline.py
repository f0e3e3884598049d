"""A corpus pipeline over ``documents``: each stage applies one operator of ``marquee.llm``.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept and returns the columns of ``documents``; the last one returns each kept
document's token ids.

Cases: a null, empty or letterless text is in no language, so language ID lets
it go; given such a text itself, every later stage keeps it: it links with
nothing, holds no passage and no secret (null stays null) and has no tokens.
Rows without an id and rows that repeat an id are handled as rows of their own;
of copies under different ids one stays, rows that repeat an id and a text stay
together.  Empty tables give no rows; an empty benchmark removes nothing.
Columns beside those a stage reads pass through it, but for the last one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, decontam, langid, ngram_join, secrets
from marquee.llm.common import broadcast_if_few, release, table, written

#: Below this share of the best language a text counts as in no known language.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language (no letters, or no clear language) go."""
    got = langid.identify(docs)
    return got.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8 or more) the smallest doc_id stays."""
    got = ngram_join.join(docs, words=5, num=8, den=10, classes_too=True)
    # A row without an id is in no group and stays; rows that repeat an id and a text stay together,
    # rows that share an id but not a text are told apart by their class.
    gone = written(got.filter(F.col("doc_id") != F.col("component_id")).select("doc_id", F.col("h").alias("__h")).distinct())
    classed = docs.withColumn("__h", ngram_join.class_of(F.col("text"), 5))
    return classed.join(broadcast_if_few(gone), ["doc_id", "__h"], "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    got = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return got.filter(~F.col("contaminated")).select(docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; no document goes."""
    got = secrets.find(docs)
    return got.withColumns({
        "text": secrets.redact(F.col("text"), F.col("findings")),
        "n_chars": F.when(F.size("findings") == 0, F.col("n_chars")).otherwise(
            F.length(secrets.redact(F.col("text"), F.col("findings")))),
    }).select(docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of what is left, with a check that they decode to the text."""
    got = bpe.encode(docs.select("doc_id", "text"), decoded="decoded")
    whole = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return got.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids",
                      whole.alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]

#: The fitted language model can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
        release(spark)
    return docs
