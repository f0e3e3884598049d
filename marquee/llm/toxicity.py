"""Toxicity by a classifier chain of linear models.

The chain's categories are the binary columns of a labels table, in the given
order; the query's are ``low_quality`` and ``toxic``.  A text's features are
its distinct lower-cased words and their first letters.  The model of a category is a logistic
regression on these features and the log odds of the categories before it.
While learning, those log odds are out of fold: each labelled row's come from
models that were fitted without its fold, so later links see inputs as uncertain as
they will be in use.  The decision threshold of each category is the one of
best F1 on the out-of-fold predictions.

Fitting.  At most about ``sample_rows`` labelled rows of each value of the last category (by a hash
of the text: an even share of equal size at any scale) have their features
gathered and fitted on the driver; words of fewer than ``LEAST_DOCS`` sampled
rows are no features.  The model is therefore bounded by the sample.  Scoring
reads every whole text, in place.

Cases: a text without words, or null, is scored by the intercepts alone; rows
with a null label or text are not learned from; labelled ids that repeat count
as often as they join; with no labelled rows, or one value only, a category's
probability is that value's share (0 without rows); other columns are kept,
columns named as the outputs are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_column, broadcast_if_few, text_chunks, written

SAMPLE_ROWS = 2000
LEAST_DOCS = 5
FOLDS = 3
STEPS = 200
#: Longer words also count by their first letters, which covers inflected and unseen forms.
STEM = 4
PENALTY = 4.0
_WORD = re.compile(r"[^\W_]+")


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' distinct words and stems, text after text, and each text's number of them."""
    rows = [set(_WORD.findall(t.lower())) for t in texts]
    for r in rows:
        r.update([w[:STEM] + "*" for w in r if len(w) > STEM])
    sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
    number: dict[str, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for r in rows for w in r), dtype=np.int64, count=int(sizes.sum()))
    digest = np.fromiter(map(xxhash.xxh3_64_intdigest, number), dtype=np.uint64, count=len(number))
    return (digest[codes] if len(digest) else np.zeros(0, np.uint64)), sizes


def _share(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


class Linear:
    """Logistic regression on sparse binary features (row, column pairs) and a few dense ones."""

    def __init__(self, row, column, dense, y, width: int):
        self.weights, self.extra, self.bias = np.zeros(width), np.zeros(dense.shape[1]), 0.0
        n, share = max(1, len(y)), float(np.mean(y)) if len(y) else 0.0
        if share in (0.0, 1.0):
            self.bias = 30.0 if share else -30.0
            return
        self.bias = float(np.log(share / (1 - share)))
        squares = [np.full(width, 1e-8), np.full(dense.shape[1], 1e-8), 1e-8]
        for _ in range(STEPS):
            wrong = _share(self.odds(row, column, dense, n)) - y
            slopes = (np.bincount(column, weights=wrong[row], minlength=width), dense.T @ wrong + self.extra, wrong.sum())
            squares = [s + g * g for s, g in zip(squares, slopes, strict=True)]
            moves = [0.3 * g / np.sqrt(s) for g, s in zip(slopes, squares, strict=True)]
            # The absolute penalty drops words that tell little, whose sum would grow with a text's length.
            stepped = self.weights - moves[0]
            self.weights = np.sign(stepped) * np.maximum(0, np.abs(stepped) - 0.3 * PENALTY / np.sqrt(squares[0]))
            self.extra -= moves[1]
            self.bias -= moves[2]

    def odds(self, row, column, dense, n: int) -> np.ndarray:
        return np.bincount(row, weights=self.weights[column], minlength=n)[:n] + dense @ self.extra + self.bias


class Chain:
    def __init__(self, categories: list[str], words: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        self.categories = categories
        row = np.repeat(np.arange(len(sizes)), sizes)
        kinds, column, uses = np.unique(words, return_inverse=True, return_counts=True)
        keep = uses >= LEAST_DOCS
        self.words = kinds[keep]
        used = keep[column]
        row, column = row[used], (np.cumsum(keep) - 1)[column[used]]
        # The rows come in no order of their own (sorted by hash), so every third is a random fold.
        fold = np.arange(len(sizes)) % FOLDS
        before, self.models, self.thresholds = np.zeros((len(sizes), 0)), [], []
        for k in range(len(categories)):
            y, odds = labels[:, k].astype(np.float64), np.zeros(len(sizes))
            for f in range(FOLDS):
                learn = fold != f
                place = np.cumsum(learn) - 1
                inside = learn[row]
                part = Linear(place[row[inside]], column[inside], before[learn], y[learn], len(self.words))
                odds[~learn] = part.odds(row, column, before, len(sizes))[~learn]
            self.models.append(Linear(row, column, before, y, len(self.words)))
            self.thresholds.append(_best_threshold(_share(odds), y))
            before = np.concatenate([before, np.clip(odds, -30, 30)[:, None]], axis=1)
        self.table = np.array([m.weights for m in self.models]).reshape(len(categories), len(self.words))

    def predict(self, texts: list[str]) -> np.ndarray:
        """Probabilities, one row for each text and one column for each category."""
        words, sizes = features(texts)
        row = np.repeat(np.arange(len(texts)), sizes)
        at = np.searchsorted(self.words, words)
        known = np.zeros(len(words), dtype=bool)
        inside = at < len(self.words)
        known[inside] = self.words[at[inside]] == words[inside]
        row, column = row[known], at[known]
        before = np.zeros((len(texts), 0))
        for k, model in enumerate(self.models):
            odds = (np.bincount(row, weights=self.table[k][column], minlength=len(texts)) + before @ model.extra + model.bias)
            before = np.concatenate([before, np.clip(odds, -30, 30)[:, None]], axis=1)
        return _share(before)


def _best_threshold(share: np.ndarray, y: np.ndarray) -> float:
    order = np.argsort(-share)
    hits = np.cumsum(y[order])
    if not len(y) or hits[-1] in (0, len(y)):
        return 0.5
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + hits[-1])
    best = int(np.argmax(f1))
    below = share[order[best + 1]] if best + 1 < len(y) else 0.0
    return float((share[order[best]] + below) / 2)


def fit(labelled: DataFrame, categories: list[str], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Chain:
    """Learn from rows of ``text`` and the binary columns ``categories``."""
    rows = labelled.select(F.col(text).alias("text"), *[F.col(c).cast("int").alias(f"y{k}") for k, c in enumerate(categories)])
    rows = rows.dropna()
    last = f"y{len(categories) - 1}"
    sizes = {r[0]: r[1] for r in rows.groupBy(last).count().collect()}  # two values
    near = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.lit(1.0)
    for value, n in sizes.items():
        share = F.when(F.col(last) == value, F.lit(min(1.0, sample_rows / n))).otherwise(share)
    taken = rows.filter(near <= share)

    def hashed(batches):
        for batch in batches:
            words, counts = features(batch.column("text").to_pylist())
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([words[a:b].tobytes() for a, b in zip(ends - counts, ends, strict=True)], pa.binary()),
                 *[batch.column(f"y{k}") for k in range(len(categories))]],
                names=["words", *[f"y{k}" for k in range(len(categories))]])

    kinds = ", ".join(f"y{k} int" for k in range(len(categories)))
    # Bounded: about sample_rows rows for each of two values.
    got = sorted((bytes(r["words"]), *r[1:]) for r in taken.mapInArrow(hashed, f"words binary, {kinds}").collect())
    got.sort(key=lambda r: xxhash.xxh3_64_intdigest(r[0]))
    words = [np.frombuffer(r[0], dtype=np.uint64) for r in got]
    labels = np.array([r[1:] for r in got], dtype=np.int64).reshape(len(got), len(categories))
    return Chain(categories, np.concatenate(words) if words else np.zeros(0, np.uint64),
                 np.array([len(w) for w in words], dtype=np.int64), labels)


def predict(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """``docs`` with ``p_<category>`` and boolean ``<category>`` for each link of the chain."""
    sent = docs.sparkSession.sparkContext.broadcast(chain)  # bounded by the fit's sample
    kind = "struct<" + ",".join(f"p{k}:double" for k in range(len(chain.categories))) + ">"

    def kernel(batch: pa.Array) -> pa.Array:
        got = [sent.value.predict(chunk) for chunk in text_chunks(batch)]
        share = np.concatenate(got) if got else np.zeros((0, len(chain.categories)))
        return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in share.T],
                                          names=[f"p{k}" for k in range(len(chain.categories))])

    outputs = {}
    for k, c in enumerate(chain.categories):
        outputs[f"p_{c}"] = F.col(f"__s.p{k}")
        outputs[c] = F.col(f"__s.p{k}") >= F.lit(chain.thresholds[k])
    got = docs.drop("__s", *outputs).withColumn("__s", arrow_column(kernel, kind)(F.col(text)))
    return got.withColumns(outputs).drop("__s")


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn from ``labels`` (doc_id, quality, toxic) joined to ``docs``; predict every document."""
    # The sample is drawn before the texts are joined, so that only its texts are moved.
    drawn = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic").dropna()
    sizes = {r[0]: r[1] for r in drawn.groupBy("toxic").count().collect()}
    share = F.lit(1.0)
    for value, n in sizes.items():
        share = F.when(F.col("toxic") == value, F.lit(min(1.0, sample_rows / n))).otherwise(share)
    near = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = written(drawn.filter(near <= share))
    known = docs.select("doc_id", "text").join(broadcast_if_few(drawn), "doc_id")
    chain = fit(known, ["low_quality", "toxic"], sample_rows=10 * sample_rows)
    return predict(docs, chain)
