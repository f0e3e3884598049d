"""Language ID, word first: a known word is scored by its log frequency in each
language, an unseen one by its longest known character n-grams.

Learning.  Words (runs of letters, lower-cased) are counted for each language
over labelled rows.  To bound the model that every task holds, the fit takes at
most ``sample_rows`` labelled rows of a language (those with the smallest hash
of the text; all of them if there are fewer) - the only sampled step.  Counting
is a map-side combined group-by of (word, language); character n-grams are
counted from the distinct words, weighted by the words' counts.

Prediction.  A word of the model adds ``log((count + a) / (total + a * size))``
for each language.  Any other word is framed by blanks and cut into n-grams of
the longest order of which one is known; the mean of the known n-grams' log
frequencies is added.  Sums are turned into shares; the largest share is the score, ties
go to the first language in order.

Cases: null text, or one with no letter: ``und`` and 0.0.  No labelled rows:
``und`` and 0.0 for all.  A text none of whose n-grams is known: the first
language, with an even share.  Only the text is an input of a prediction; other
columns are kept, columns named as the outputs are replaced.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_column, made_once, text_chunks

SAMPLE_ROWS = 4000
ORDERS = (5, 4, 3, 2, 1)
SMOOTH = 0.5
#: Unseen words whose scores a worker remembers.
REMEMBERED = 200_000

#: Numbers such as a superscript two or a Roman numeral are word characters and no digits, but no letters either.
_NUMBERS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not c.isalpha() and not c.isdecimal())
_LETTERS = re.compile(rf"[^\W\d_{_NUMBERS}]+")
#: The same and those numbers: the hundreds of signs in the set above cost most of a scan's time.
_RUNS = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    found = _RUNS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    # Only runs that hold such a number are cut at it.
    return [part for run in found for part in ([run] if run.isalpha() else _LETTERS.findall(run))]


def _ngrams(word: str, n: int) -> list[str]:
    framed = f" {word} "
    return [framed[i:i + n] for i in range(len(framed) - n + 1)]


class Model:
    """Log frequencies of words and n-grams, one row for each."""

    def __init__(self, langs: list[str], counts: dict[str, np.ndarray]):
        self.langs = langs
        self.words, self.word_scores = self._table(counts)
        grams: list[dict[str, np.ndarray]] = [{} for _ in ORDERS]
        for word, c in counts.items():
            for k, n in enumerate(ORDERS):
                for g in _ngrams(word, n):
                    if g != " ":
                        at = grams[k].get(g)
                        grams[k][g] = c.copy() if at is None else at + c
        self.grams = [self._table(g) for g in grams]

    def _table(self, counts: dict[str, np.ndarray]) -> tuple[dict[str, int], np.ndarray]:
        if not counts:
            return {}, np.zeros((0, len(self.langs)))
        keys = sorted(counts)
        seen = np.array([counts[k] for k in keys], dtype=np.float64)
        scores = np.log((seen + SMOOTH) / (seen.sum(axis=0) + SMOOTH * len(keys)))
        return {k: i for i, k in enumerate(keys)}, scores

    def unseen(self, word: str) -> np.ndarray:
        for n, (at, scores) in zip(ORDERS, self.grams, strict=True):
            if known := [at[g] for g in _ngrams(word, n) if g in at]:
                return scores[known].mean(axis=0)
        return np.zeros(len(self.langs))


class Predictor:
    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def score(self, word: str) -> np.ndarray:
        at = self.model.words.get(word)
        if at is not None:
            return self.model.word_scores[at]
        if (got := self.known.get(word)) is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            got = self.model.unseen(word)
            if len(word) <= 64:
                self.known[word] = got
        return got

    def predict(self, batch: list[str]) -> tuple[list[str], list[float]]:
        number: dict[str, int] = {}
        rows = [np.array([number.setdefault(w, len(number)) for w in words(t)], dtype=np.int64) for t in batch]
        if not self.model.langs or not number:
            return ["und"] * len(batch), [0.0] * len(batch)
        scores = np.array([self.score(w) for w in number])
        langs, shares = [], []
        for own in rows:
            if not len(own):
                langs.append("und")
                shares.append(0.0)
                continue
            sums = np.bincount(own, minlength=0)
            used = np.flatnonzero(sums)
            total = sums[used].astype(np.float64) @ scores[used]
            best = int(np.argmax(total))
            langs.append(self.model.langs[best])
            shares.append(float(1.0 / np.exp(total - total[best]).sum()))
        return langs, shares


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the rows whose ``lang`` and ``text`` are not null."""
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = rows.groupBy("lang").count()
    # A hash below sample_rows / rows of the language: about sample_rows rows of each, with no sort.
    share = F.least(F.lit(1.0), F.lit(float(sample_rows)) / F.col("count"))
    near = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    taken = rows.join(F.broadcast(sizes), "lang").filter(near <= share).select("lang", "text")

    def count_words(batches):
        for batch in batches:
            seen: dict[tuple[str, str], int] = {}
            names = iter(batch.column("lang").to_pylist())
            for part in text_chunks(batch.column("text")):
                for body in part:
                    name = next(names)
                    for w in words(body):
                        seen[name, w] = seen.get((name, w), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
                 pa.array(list(seen.values()), pa.int64())], names=["lang", "word", "n"])

    counted = taken.mapInArrow(count_words, "lang string, word string, n bigint").groupBy("lang", "word").agg(
        F.sum("n").alias("n"))
    langs: dict[str, int] = {}
    seen: dict[str, dict[str, int]] = {}
    # Bounded by the sample: the distinct words of sample_rows rows of each language.
    for r in counted.orderBy("lang", "word").toLocalIterator():
        langs.setdefault(r["lang"], len(langs))
        seen.setdefault(r["word"], {})[r["lang"]] = r["n"]
    names = list(langs)
    return Model(names, {w: np.array([c.get(x, 0) for x in names], dtype=np.float64) for w, c in seen.items()})


def predict(docs: DataFrame, model: Model, text: str = "text", out_lang: str = "lang_pred",
            out_score: str = "score") -> DataFrame:
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # bounded by the fit's sample

    def kernel(batch: pa.Array) -> pa.Array:
        langs, shares = [], []
        for part in text_chunks(batch):
            got = made_once("predictor", sent, Predictor).predict(part)
            langs += got[0]
            shares += got[1]
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(shares, pa.float64())],
                                          names=["lang", "score"])

    got = docs.drop(out_lang, out_score, "__p").withColumn(
        "__p", arrow_column(kernel, "struct<lang:string,score:double>")(F.col(text)))
    return got.withColumns({out_lang: F.col("__p.lang"), out_score: F.col("__p.score")}).drop("__p")


def held_out(doc_id: str = "doc_id"):
    """Every fifth document by the checksum of its id (a null id: held out) is never learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
             sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn from the labelled rows that are not held out, predict every row."""
    model = fit(docs.filter(~held_out(doc_id)), text, lang, sample_rows)
    return predict(docs, model, text).withColumn("held_out", held_out(doc_id))
