"""Benchmark decontamination: one Aho-Corasick automaton over the test items.

Normal form of a text: A-Z lower-cased, every other ASCII character that is
not a digit or letter read as a gap; words are the runs in between.  The rule
maps bytes to bytes one to one, so a place in the normal form is a place in
the original.

An item's windows are its runs of ``window`` consecutive words (an item of
fewer words, but not none, is one window).  All windows of the items go into
one automaton, each framed by blanks so that only whole words match.  A
document is scanned once; a word inside any occurrence of a window is hit.

Cases: null or wordless texts have no words and no hits; wordless items have
no windows; an item id that occurs in several rows counts once, a null item id
marks words but is not listed; repeated document rows are each answered; other
columns of the documents are kept (columns named as the outputs are replaced).

Size: items of one text are made one first.  The automaton is sent to every
task, so the distinct texts are dealt, by a running total of their bytes, to
blocks of at most ``block_bytes`` (a longer single text is a block of its
own); a byte of items costs an automaton about 350 bytes.  One block needs no
shuffle of documents.  With more, each further block scans the documents
beside the first and sends only its hit words, one row for each distinct hit
text; words hit by any block are united before spans are made of them, so
the results don't depend on the blocks.
"""

from __future__ import annotations

import functools

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.prefix import running_total_by_range

from .common import arrow_column, made_once, utf8_views, written

WINDOW = 10
BLOCK_BYTES = 1 << 20

_FOLD = bytes(
    (c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32)
    for c in range(256)
)
SPANS = "array<struct<start:int,end:int>>"
RESULT = f"struct<n_words:bigint,hit_words:array<int>,items:array<bigint>,spans:{SPANS}>"
_SPANS_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_RESULT_ARROW = pa.struct([
    ("n_words", pa.int64()), ("hit_words", pa.list_(pa.int32())), ("items", pa.list_(pa.int64())),
    ("spans", _SPANS_ARROW),
])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def windows(text: bytes, window: int) -> set[bytes]:
    words = words_of(text)
    return {b" " + b" ".join(words[i:i + window]) + b" "
            for i in range(max(1, len(words) - window + 1))} if words else set()


def spans_of(text: bytes, folded: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words (ascending numbers) as places in the original, in code points."""
    if not len(hit):
        return []
    # The folded text is as long as the original: its words' bytes are the original's.
    inside = np.concatenate(([0], (np.frombuffer(folded, dtype=np.uint8) != 32).astype(np.int8), [0]))
    step = np.diff(inside)
    first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)))
    runs = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
    return [{"start": int(points[first[r[0]]]), "end": int(points[last[r[-1]]])} for r in runs]


class Scanner:
    """The automaton of one block of items (their ids and text); built once in each Python worker."""

    def __init__(self, items: list[tuple[list[int], str]], window: int):
        owners: dict[bytes, set] = {}
        for ids, text in items:
            for w in windows(text.encode(), window):
                owners.setdefault(w, set()).update(ids)
        self.automaton = ahocorasick.Automaton()
        for w, ids in owners.items():
            # Latin-1 keeps one character for each byte.
            self.automaton.add_word(w.decode("latin-1"), (len(w), tuple(ids)))
        self.some = bool(owners)
        if self.some:
            self.automaton.make_automaton()

    @classmethod
    def of(cls, sent: tuple) -> "Scanner":
        return cls(*sent)

    def scan(self, text: bytes) -> dict:
        folded = text.translate(_FOLD)
        words = folded.split()
        found: set[int] = set()
        hits: list[tuple[int, int]] = []
        if self.some and words:
            for end, (size, ids) in self.automaton.iter((b" " + b" ".join(words) + b" ").decode("latin-1")):
                found.update(ids)
                hits.append((end - size + 1, end))
        if not hits:
            return {"n_words": len(words), "hit_words": [], "items": [], "spans": []}
        # Blanks before a place in the joined text count the words before it.
        joined = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8)
        before = np.cumsum(joined == 32)
        cover = np.zeros(len(words) + 1, dtype=np.int32)
        for start, end in hits:
            cover[before[start] - 1] += 1
            cover[before[end] - 1] -= 1
        hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        return {"n_words": len(words), "hit_words": hit.tolist(), "items": sorted(found), "spans": spans_of(text, folded, hit)}


def _scan_column(spark, items: list[tuple], window: int):
    sent = spark.sparkContext.broadcast((items, window))  # one block: its bytes are counted

    def kernel(batch: pa.Array) -> pa.Array:
        scanner = made_once("scanner", sent, Scanner.of)
        return pa.array([scanner.scan(t) for t in utf8_views(batch)], _RESULT_ARROW)

    return arrow_column(kernel, RESULT)


def _spans(batch: pa.StructArray) -> pa.Array:
    text, hits = batch.flatten()
    return pa.array([spans_of(t, t.translate(_FOLD), np.asarray(h or (), dtype=np.int64))
                     for t, h in zip(utf8_views(text), hits.to_pylist(), strict=True)], _SPANS_ARROW)


def item_blocks(items: DataFrame, block_bytes: int) -> list[list[tuple[list[int], str]]]:
    """The distinct texts of ``items`` (columns i, t) with their ids, in blocks of bounded size."""
    own = written(items.filter(F.col("t").isNotNull()).groupBy("t").agg(F.collect_set("i").alias("ids"))
                  .withColumn("bytes", F.octet_length("t") + 8 * F.size("ids")))
    total = own.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()["b"]
    if total <= block_bytes:
        return [[(r["ids"], r["t"]) for r in own.collect()]]
    # Half a block by the running total up to a text, so that one more text seldom passes the bound.
    upto = written(running_total_by_range(own, ["t"], "bytes", "upto")
                   .withColumn("block", F.floor((F.col("upto") - F.col("bytes")) / max(1, block_bytes // 2))))
    numbers = sorted(r["block"] for r in upto.select("block").distinct().collect())
    return [[(r["ids"], r["t"]) for r in upto.filter(F.col("block") == b).collect()] for b in numbers]


def decontaminate(docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, hit_words (word numbers), items (sorted ids), spans (code points, end
    exclusive) and contaminated."""
    spark = docs.sparkSession
    own = bench.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).cast("string").alias("t"))
    scans = [_scan_column(spark, items, window) for items in item_blocks(own, block_bytes)]
    outputs = ["n_words", "hit_words", "items", "spans"]
    base = docs.drop(*outputs, "contaminated", "__r", "__k")
    kept = [F.col(f"`{c}`") for c in base.columns]
    got = base.withColumn("__r", scans[0](F.col(text)))
    if len(scans) == 1:
        got = got.select(*kept, *[F.col(f"__r.{c}").alias(c) for c in outputs])
        return got.withColumn("contaminated", F.size("hit_words") > 0)
    # One block is scanned and written before the next is asked for: a worker holds one automaton at a time.
    found = [written(base.select(F.col(text).alias("__t"), scan(F.col(text)).alias("__x"))
                     .filter("size(__x.hit_words) > 0")
                     .select(F.sha2("__t", 256).alias("__k"), "__x.hit_words", "__x.items").dropDuplicates(["__k"]))
             for scan in scans[1:]]
    united = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))  # noqa: E731  one list for each block
    rest = written(functools.reduce(DataFrame.union, found).groupBy("__k").agg(
        united("hit_words").alias("__hit_words"), united("items").alias("__items")))
    met = got.withColumn("__k", F.sha2(F.col(text), 256)).join(rest, "__k", "left")
    both = {c: F.array_sort(F.array_union(f"__r.{c}", F.coalesce(f"__{c}", F.expr(f"slice(__r.{c}, 1, 0)"))))
            for c in ("hit_words", "items")}
    met = met.select(*kept, F.col("__r.n_words").alias("n_words"), *[c.alias(n) for n, c in both.items()])
    spans = arrow_column(_spans, SPANS)(F.struct(F.col(text), F.col("hit_words")))
    return met.withColumn("spans", spans).withColumn("contaminated", F.size("hit_words") > 0)
