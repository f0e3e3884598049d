"""Exact substring dedup: a byte goes if a string of ``length`` bytes that covers it
also starts in a document with a smaller id.

A window is a string of ``length`` bytes.  Its bucket is the smallest hash of
the ``GRAM``-byte strings in it, so equal windows share a bucket wherever they
stand, and consecutive windows mostly share theirs: a text falls into runs of
windows, about one for every 16 bytes.  Documents are dealt by hash into
batches; only what a batch can't decide alone leaves it.

1. Each batch sends its distinct bucket numbers; a bucket that no other
   batch (and no second document of the batch) has holds no copies.  With them go
   the bytes of the distinct runs of its fuller buckets: a bucket that holds more than ``SLICE_BYTES``
   over all batches is split by a hash of whole windows (equal windows still
   meet), so its windows go to many groups.
2. Of the runs in the remaining buckets, equal ones within a batch are settled
   there (all but the smallest document's are copies); each distinct run is sent
   once, however many documents hold it.
3. Groups of buckets are suffix-sorted, one after the other, by the
   difference-cover blockwise method: ranks of the suffixes at a difference
   cover of 7 are computed by prefix doubling; then the windows are sorted one
   block of leading symbols at a time, ties beyond the first seven symbols
   being resolved by the cover ranks.  Neighbours that agree on ``length``
   bytes are equal windows; each run learns which of its windows stand in a smaller document.
4. Each batch marks, cuts and returns its documents.

A batch's and a bucket group's memory is bounded; steps are cut by tables in the shared
folder, and the answers to a batch are bits, in the order in which it asked.

Cases: null text counts as empty; texts shorter than ``length`` lose nothing;
rows without an id neither lose bytes nor cause others to; rows that share an
id don't affect each other, nor does a document itself; other columns are not returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, row_count_bytes, utf8_views, written
from .ngram_join import mix

LENGTH = 50
GRAM = 20
#: Bytes of text in a batch, and of text whose buckets form a group.
BATCH_BYTES = 6 << 20
GROUP_BYTES = 64 << 20
#: Bytes of runs whose suffixes are ordered at once (whole buckets).
SLICE_BYTES = 2 << 20
#: Bytes of distinct runs up to which a batch doesn't say how full a bucket is.
LIGHT_BYTES = 256
#: Bytes hashed at once, windows sorted at once, windows in a run at most.
CHUNK, BLOCK, RUN = 1 << 18, 1 << 18, 256
_U = np.uint64


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each run of GRAM bytes (three overlapping words)."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, _U)
    word = lambda at: np.ndarray(shape=(n,), dtype="<u8", buffer=data, offset=at, strides=(1,)).copy()
    x = word(0) * _U(0x9E3779B97F4A7C15)
    x ^= x >> _U(29)
    x += word(8)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(32)
    x += word(GRAM - 8)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def runs(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one bucket: text number, first window, windows, bucket number."""
    parts = []
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= CHUNK):
            size += len(texts[to])
            to += 1
        parts.append(_runs(texts[at:to], length, at))
        at = to
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, _U))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _runs(texts: list[bytes], length: int, number: int):
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, np.zeros(0, _U)
    least = gram_hashes(data)
    wide, covered = length - GRAM + 1, 1
    while covered * 2 <= wide:
        least = np.minimum(least[:-covered], least[covered:])
        covered *= 2
    if covered < wide:
        least = np.minimum(least[:len(least) - (wide - covered)], least[wide - covered:])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)[:len(least)]
    place = np.arange(len(least)) - starts[owner]
    whole = place + length <= sizes[owner]
    least, owner, place = least[whole], owner[whole], place[whole]
    if not len(least):
        return none, none, none, np.zeros(0, _U)
    new = np.ones(len(least), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    # Long runs (repetitive text) are cut, which changes no window's bucket.
    count = np.diff(np.append(first, len(least)))
    pieces = -(-count // RUN)
    offset = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(first, pieces) + offset * RUN
    count = np.minimum(np.repeat(count, pieces) - offset * RUN, RUN)
    # Minima crowd at the low end of the hashes; scattered again they deal out evenly.
    return owner[begin] + number, place[begin], count, mix(least[begin])


def _group_of(buckets: np.ndarray, groups: int) -> np.ndarray:
    """Ranges of bucket numbers: sorted numbers give sorted groups."""
    return ((buckets >> _U(32)) * _U(groups) >> _U(32)).astype(np.int64)


_DELTA = [[next(d for d in range(7) if (a + d) % 7 in (0, 1, 3) and (b + d) % 7 in (0, 1, 3)) for b in range(7)]
          for a in range(7)]
#: The first step from each residue into the cover.
_STEP = np.array([_DELTA[r][r] for r in range(7)])


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64) + 1


class Suffixes:
    """The windows of distinct runs in suffix order.

    Symbols are bytes plus one; zero follows the end of a run.  Seven symbols of nine bits make
    a key.  Runs are placed so that their bucket's gram starts at a multiple of seven: equal windows of
    different runs then share a residue, though the method holds for any placement.
    """

    def __init__(self, contents: list[bytes], windows: np.ndarray, buckets: np.ndarray, length: int):
        self.length = length
        sizes = np.array([len(c) for c in contents], dtype=np.int64)
        joined = np.frombuffer(b"".join(contents), dtype=np.uint8)
        run = np.repeat(np.arange(len(contents)), sizes)
        begin = np.cumsum(sizes) - sizes
        hashes = mix(gram_hashes(joined))
        at = np.flatnonzero(hashes == buckets[run[:len(hashes)]])
        gram = np.zeros(len(contents), dtype=np.int64)
        gram[run[at[::-1]]] = (at - begin[run[at]])[::-1]
        # Each run gets its size plus 7 to 13 places, the last seven at least empty.
        room = sizes + 7
        room += -room % 7
        shift = -gram % 7
        start = np.cumsum(room + 7) - (room + 7) + shift
        text = np.zeros(int((room + 7).sum()) + 64, dtype=_U)
        text[np.repeat(start - begin, sizes) + np.arange(len(joined))] = joined.astype(_U) + _U(1)
        self.key = np.zeros(len(text) - 7, dtype=_U)
        for k in range(7):
            self.key = (self.key << _U(9)) | text[k:len(text) - 7 + k]
        self.rank = self._cover_ranks(int(sizes.max()))
        first = np.cumsum(windows) - windows
        self.run = np.repeat(np.arange(len(contents)), windows)
        self.place = np.arange(int(windows.sum())) - first[self.run] + start[self.run]

    def _cover_ranks(self, longest: int) -> np.ndarray:
        """Ranks, from one, of the suffixes at the cover; equal only for equal suffixes.  Zero past an end."""
        place = np.arange(len(self.key))
        cover = place[np.isin(place % 7, (0, 1, 3)) & (self.key != 0)]
        rank = np.zeros(len(self.key) + 7, dtype=np.int64)
        rank[cover] = _dense(self.key[cover])
        # Keys of seven symbols that hold an end are unlike all others, so a step past it is never decisive.
        # Windows are told apart within their length, so ranks need to look no further.
        step, last = 7, self.key & _U(511)
        ended = np.zeros(len(rank), dtype=bool)
        ended[cover] = last[cover] == 0
        while step < min(longest, self.length):
            ahead = np.minimum(cover + step, len(rank) - 1)
            follow = np.where(ended[cover], 0, rank[ahead])
            now = _dense(rank[cover] * (len(cover) + 2) + follow)
            over = ended[cover] | ended[ahead] | (follow == 0)
            rank[cover], ended[cover] = now, over
            step *= 2
        return rank

    def ordered_groups(self):
        """Yield, block by block, the windows in suffix order and a mark where one differs from the one before."""
        key = self.key[self.place]
        sample = np.sort(key[::max(1, len(key) // 4096)])
        cuts = np.unique(sample[::max(1, len(sample) * BLOCK // max(1, len(key)))])[1:]
        block = np.searchsorted(cuts, key, side="right")
        by_block = np.argsort(block, kind="stable")
        edges = np.searchsorted(block[by_block], np.arange(len(cuts) + 2))
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                yield self._block(by_block[a:b], key)

    def _block(self, windows: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        windows = windows[np.argsort(key[windows], kind="stable")]
        own = key[windows]
        new = np.ones(len(own), dtype=bool)
        new[1:] = own[1:] != own[:-1]
        tie = np.cumsum(new) - 1
        place = self.place[windows]
        residue = place % 7
        size = np.bincount(tie)
        mixed = np.zeros(len(size), dtype=bool)
        differs = np.zeros(len(own), dtype=bool)
        differs[1:] = (tie[1:] == tie[:-1]) & (residue[1:] != residue[:-1])
        mixed[tie[differs]] = True
        wide = int(self.rank.max()) + 2
        # Ties of one residue: the same step leads all of them into the cover.
        order = self.rank[place + _STEP[residue]]
        rows = np.flatnonzero(mixed[tie])
        if len(rows):
            order[rows] = self._mixed_order(tie[rows], place[rows], residue[rows], wide)
        sort = np.argsort(tie * wide + order, kind="stable")
        windows, place = windows[sort], place[sort]
        differs = np.ones(len(windows), dtype=bool)
        if len(windows) > 1:
            same = np.ones(len(windows) - 1, dtype=bool)
            for offset in [*range(0, self.length - 6, 7), self.length - 7]:
                word = self.key[place + offset]
                same &= word[1:] == word[:-1]
            differs[1:] = ~same
        return windows, differs

    def _mixed_order(self, tie, place, residue, wide) -> np.ndarray:
        """For ties of several residues: how many of the tie are smaller, counted residue by residue."""
        smaller = np.zeros(len(tie), dtype=np.int64)
        members = [np.flatnonzero(residue == r) for r in range(7)]
        for a in range(7):
            for b in range(7):
                x, y, d = members[a], members[b], _DELTA[a][b]
                if len(x) and len(y):
                    other = np.sort(tie[y] * wide + self.rank[place[y] + d])
                    base = tie[x] * wide
                    smaller[x] += np.searchsorted(other, base + self.rank[place[x] + d]) - np.searchsorted(other, base)
        return smaller

    def smallest(self, docs: np.ndarray) -> np.ndarray:
        """For each window the smallest of ``docs`` (one for each run) over all equal windows."""
        out = np.empty(len(self.place), dtype=np.int64)
        for windows, differs in self.ordered_groups():
            first = np.flatnonzero(differs)
            least = np.minimum.reduceat(docs[self.run[windows]], first)
            out[windows] = least[np.cumsum(differs) - 1]
        return out


def _window_minima(runs_of: list[tuple[int, bytes]], windows: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For each window of distinct runs (bucket, bytes) the smallest of ``docs`` over all equal windows.

    A run that is alone in its bucket meets no other run's windows; only the rest are sorted."""
    least = np.repeat(docs, windows)
    bucket = np.array([k for k, _ in runs_of], dtype=_U)
    order = np.argsort(bucket, kind="stable")
    same = bucket[order][1:] == bucket[order][:-1]
    met = np.zeros(len(bucket), dtype=bool)
    met[order[1:][same]] = met[order[:-1][same]] = True
    if met.any():
        own = np.flatnonzero(met)
        found = Suffixes([runs_of[k][1] for k in own], windows[own], bucket[own], length).smallest(docs[own])
        least[np.repeat(met, windows)] = found
    return least


class Batch:
    """One batch's documents, in an order that every step finds again."""

    def __init__(self, docs: pa.Table, length: int, groups: int):
        rows = sorted(zip(docs.column("doc_id").to_pylist(), utf8_views(docs.column("text").combine_chunks()
                          if docs.num_rows else pa.array([], pa.string())), strict=True))
        self.ids = np.array([r[0] for r in rows], dtype=np.int64)
        self.texts, self.length, self.groups = [r[1] for r in rows], length, groups
        self.doc, self.start, self.count, bucket = runs(self.texts, length)
        self.buckets, self.at = np.unique(bucket, return_inverse=True)
        self.bounds = np.searchsorted(_group_of(self.buckets, groups), np.arange(groups + 1))

    def twice(self) -> np.ndarray:
        """Buckets of two or more rows of this batch."""
        pairs = np.sort(self.at * (len(self.ids) + 1) + self.doc)
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs
        return np.bincount(pairs // (len(self.ids) + 1), minlength=len(self.buckets)) > 1

    def full(self) -> np.ndarray:
        """Bytes of distinct runs in each bucket, where above LIGHT_BYTES (else 0)."""
        extra = self.length - 1
        size = np.bincount(self.at, weights=self.count + extra, minlength=len(self.buckets)).astype(np.int64)
        own = np.flatnonzero(size[self.at] > LIGHT_BYTES)
        distinct = {(k, self.texts[d][s:s + c + extra]) for k, d, s, c in zip(
            self.at[own].tolist(), self.doc[own].tolist(), self.start[own].tolist(), self.count[own].tolist(), strict=True)}
        out = np.zeros(len(self.buckets), dtype=np.int64)
        np.add.at(out, np.array([k for k, _ in distinct], dtype=np.int64), np.array([len(c) for _, c in distinct], dtype=np.int64))
        return np.where(out > LIGHT_BYTES, out, 0)

    def _split(self, value: np.ndarray, parts: np.ndarray) -> np.ndarray:
        """Cut the runs of split buckets into windows, each with the number of its part; the runs' bucket numbers."""
        hot = np.flatnonzero(parts > 1)
        wide = self.count[hot]
        run = np.repeat(hot, wide)
        start = self.start[run] + np.arange(len(run)) - np.repeat(np.cumsum(wide) - wide, wide)
        digest = np.fromiter((xxhash.xxh3_64_intdigest(self.texts[d][s:s + self.length]) for d, s in zip(
            self.doc[run].tolist(), start.tolist(), strict=True)), dtype=_U, count=len(run))
        part = mix(value[run] ^ mix(digest % parts[run].astype(_U) + _U(1)))
        cold = parts <= 1
        self.doc = np.concatenate((self.doc[cold], self.doc[run]))
        self.start = np.concatenate((self.start[cold], start))
        self.count = np.concatenate((self.count[cold], np.ones(len(run), np.int64)))
        return np.concatenate((value[cold], part))

    def share(self, bits: dict[int, bytes], splits: dict[int, bytes]) -> None:
        """Take the answers to the first question and collect the distinct runs of shared buckets."""
        shared = np.zeros(len(self.buckets), dtype=bool)
        for g, raw in bits.items():
            a, b = self.bounds[g], self.bounds[g + 1]
            shared[a:b] = np.unpackbits(np.frombuffer(raw, np.uint8), count=b - a)
        parts = np.ones(len(self.buckets), dtype=np.int64)
        for g, raw in splits.items():
            place, number_of = np.frombuffer(raw, dtype=np.int64).reshape(2, -1)
            parts[self.bounds[g] + place] = number_of
        used = np.flatnonzero(shared[self.at])
        self.doc, self.start, self.count, at = self.doc[used], self.start[used], self.count[used], self.at[used]
        value, at = np.unique(self._split(self.buckets[at], parts[at]), return_inverse=True)
        # By bucket, so that each group's runs stand together.
        used = np.argsort(at, kind="stable")
        self.doc, self.start, self.count, at = self.doc[used], self.start[used], self.count[used], at[used]
        number: dict[tuple[int, bytes], int] = {}
        extra = self.length - 1
        self.content = np.array([number.setdefault((k, self.texts[d][s:s + c + extra]), len(number)) for k, d, s, c in zip(
            at.tolist(), self.doc.tolist(), self.start.tolist(), self.count.tolist(), strict=True)], dtype=np.int64)
        self.contents = [c for _, c in number]
        bucket = np.array([k for k, _ in number], dtype=np.int64)
        self.bucket = value[bucket] if len(bucket) else np.zeros(0, _U)
        self.smallest = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(self.smallest, self.content, self.ids[self.doc])
        self.windows = np.array([len(c) - extra for c in self.contents], dtype=np.int64)
        self.content_bounds = np.searchsorted(_group_of(self.bucket, self.groups), np.arange(self.groups + 1))

    def removed(self, masks: dict[int, bytes]) -> list[list[tuple[int, int]]]:
        """Take the answers to the second question; the removed spans of each text."""
        first = np.concatenate(([0], np.cumsum(self.windows)))
        copy = np.zeros(int(first[-1]), dtype=bool)
        for g, raw in masks.items():
            a, b = first[self.content_bounds[g]], first[self.content_bounds[g + 1]]
            copy[a:b] = np.unpackbits(np.frombuffer(raw, np.uint8), count=b - a)
        steps = [np.zeros(0, np.int64)] * len(self.texts)
        # Every window of a run that a smaller document of the batch has too, else what the answers say.
        later = self.ids[self.doc] > self.smallest[self.content]
        run = np.repeat(np.arange(len(self.doc)), self.count)
        offset = np.arange(len(run)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        gone = later[run] | copy[first[self.content[run]] + offset]
        run, offset = run[gone], offset[gone]
        doc, place = self.doc[run], self.start[run] + offset
        order = np.lexsort((place, doc))
        doc, place = doc[order], place[order]
        edges = np.searchsorted(doc, np.arange(len(self.texts) + 1))
        out = []
        for k in range(len(self.texts)):
            steps = place[edges[k]:edges[k + 1]]
            if not len(steps):
                out.append([])
                continue
            gap = np.flatnonzero(np.diff(steps) > self.length)
            begin, end = steps[np.append(0, gap + 1)], steps[np.append(gap, len(steps) - 1)] + self.length
            out.append(list(zip(begin.tolist(), end.tolist(), strict=True)))
        return out


def _answers(table: pa.Table, kind: str) -> dict[int, bytes]:
    rows = table.filter(pa.compute.equal(table.column("kind"), kind)) if table.num_rows else table
    return dict(zip(rows.column("grp").to_pylist(), rows.column("blob").to_pylist(), strict=True))


ANSWER = "batch bigint, grp bigint, kind string, blob binary"
RESULT = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, spans`` (removed bytes, maximal, end exclusive) and ``kept`` (the remaining bytes)."""
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    _, size = row_count_bytes(docs, "text")
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    batches = max(parallel, -(-size // BATCH_BYTES))
    groups = max(parallel, -(-size // GROUP_BYTES))
    dealt = docs.filter("doc_id is not null").withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)))

    def ask(table: pa.Table) -> pa.Table:
        b = Batch(table, length, groups)
        twice, full = b.twice(), b.full()
        listed = [np.flatnonzero(full[x:y]) for x, y in zip(b.bounds, b.bounds[1:], strict=False)]
        spans = [(g, int(x), int(y)) for g, (x, y) in enumerate(zip(b.bounds, b.bounds[1:], strict=False)) if y > x]
        return pa.table({
            "batch": pa.array([table.column("batch")[0].as_py()] * len(spans), pa.int64()),
            "grp": pa.array([g for g, _, _ in spans], pa.int64()),
            "buckets": pa.array([b.buckets[x:y].tobytes() for _, x, y in spans], pa.binary()),
            "twice": pa.array([np.packbits(twice[x:y]).tobytes() for _, x, y in spans], pa.binary()),
            "full": pa.array([np.stack([listed[g], full[x:y][listed[g]]]).tobytes() for g, x, y in spans], pa.binary())})

    def share(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = [np.frombuffer(r["buckets"], dtype=_U) for r in rows]
        twice = np.concatenate([np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=len(x))
                                for r, x in zip(rows, own, strict=True)])
        _, at, uses = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        more = uses > 1
        more[at[twice > 0]] = True
        ends = np.cumsum([len(x) for x in own])
        shared = np.split(more[at], ends[:-1])
        # At most: a batch that doesn't say how full a bucket is has LIGHT_BYTES of it.
        size = uses * LIGHT_BYTES
        for r, end, x in zip(rows, ends, own, strict=True):
            place, full = np.frombuffer(r["full"], dtype=np.int64).reshape(2, -1)
            size[at[end - len(x) + place]] += full - LIGHT_BYTES
        # A run of n bytes has fewer than n windows, each of ``length`` bytes on its own.
        parts = np.split(np.where(size > SLICE_BYTES, -(-size * length // SLICE_BYTES), 1)[at], ends[:-1])
        splits = [np.stack([k, x[k]]).tobytes() for x in parts for k in (np.flatnonzero(x > 1),)]
        blobs = [(r, "shared", np.packbits(x).tobytes()) for r, x in zip(rows, shared, strict=True)] + [
            (r, "split", x) for r, x in zip(rows, splits, strict=True) if x]
        return pa.table({"batch": pa.array([r["batch"] for r, _, _ in blobs], pa.int64()),
                         "grp": pa.array([r["grp"] for r, _, _ in blobs], pa.int64()),
                         "kind": pa.array([kind for _, kind, _ in blobs], pa.string()),
                         "blob": pa.array([x for _, _, x in blobs], pa.binary())})

    def send(key, table: pa.Table, answers: pa.Table) -> pa.Table:
        b = Batch(table, length, groups)
        b.share(_answers(answers, "shared"), _answers(answers, "split"))
        spans = [(g, int(x), int(y)) for g, (x, y) in
                 enumerate(zip(b.content_bounds, b.content_bounds[1:], strict=False)) if y > x]
        sizes = np.array([len(c) for c in b.contents], dtype="<i4")
        pack = zstandard.ZstdCompressor(level=1)
        return pa.table({
            "batch": pa.array([key[0].as_py()] * len(spans), pa.int64()),
            "grp": pa.array([g for g, _, _ in spans], pa.int64()),
            "bytes": pa.array([pack.compress(b"".join(b.contents[x:y])) for _, x, y in spans], pa.binary()),
            "sizes": pa.array([sizes[x:y].tobytes() for _, x, y in spans], pa.binary()),
            "buckets": pa.array([b.bucket[x:y].tobytes() for _, x, y in spans], pa.binary()),
            "docs": pa.array([b.smallest[x:y].tobytes() for _, x, y in spans], pa.binary())})

    def sort(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        unpack = zstandard.ZstdDecompressor()
        for r in rows:
            r["bytes"] = unpack.decompress(r["bytes"])
        buckets = [np.frombuffer(r["buckets"], dtype=_U) for r in rows]
        ends = [np.cumsum(np.frombuffer(r["sizes"], "<i4").astype(np.int64)) for r in rows]
        owners = [np.frombuffer(r["docs"], dtype=np.int64) for r in rows]
        total = np.sort(np.concatenate([np.stack([b, np.diff(np.concatenate(([0], e))).astype(_U)], axis=1)
                                        for b, e in zip(buckets, ends, strict=True)]).view("u8,u8").ravel(), order="f0")
        filled = np.cumsum(total["f1"].astype(np.int64)) // SLICE_BYTES
        # Slices of whole buckets, each of about SLICE_BYTES; every batch's runs come in order of their buckets.
        cuts = np.unique(total["f0"][np.flatnonzero(np.diff(filled)) + 1]) if len(total) else np.zeros(0, _U)
        edges = [np.concatenate(([0], np.searchsorted(b, cuts), [len(b)])) for b in buckets]
        copies = [np.zeros(int((np.diff(np.concatenate(([0], e))) - length + 1).sum()), dtype=bool) for e in ends]
        place = [0] * len(rows)
        for k in range(len(cuts) + 1):
            number: dict[tuple[int, bytes], int] = {}
            used, codes = [], []
            for at, r in enumerate(rows):
                x, y = int(edges[at][k]), int(edges[at][k + 1])
                if y > x:
                    stops = ends[at][x:y].tolist()
                    starts = [int(ends[at][x - 1]) if x else 0, *stops[:-1]]
                    codes.append(np.array([number.setdefault((c, r["bytes"][i:j]), len(number)) for c, i, j in zip(
                        buckets[at][x:y].tolist(), starts, stops, strict=True)], dtype=np.int64))
                    used.append((at, x, y))
            if not number:
                continue
            smallest = np.full(len(number), np.iinfo(np.int64).max)
            for (at, x, y), code in zip(used, codes, strict=True):
                np.minimum.at(smallest, code, owners[at][x:y])
            windows = np.array([len(c) - length + 1 for _, c in number], dtype=np.int64)
            least = _window_minima(list(number), windows, smallest, length)
            first = np.cumsum(windows) - windows
            for (at, x, y), code in zip(used, codes, strict=True):
                wide = windows[code]
                inside = np.repeat(first[code] - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())
                copies[at][place[at]:place[at] + len(inside)] = least[inside] < np.repeat(owners[at][x:y], wide)
                place[at] += len(inside)
        return pa.table({"batch": pa.array([r["batch"] for r in rows], pa.int64()),
                         "grp": pa.array([r["grp"] for r in rows], pa.int64()),
                         "kind": pa.array(["copies"] * len(rows), pa.string()),
                         "blob": pa.array([np.packbits(c).tobytes() for c in copies], pa.binary())})

    def cut(key, table: pa.Table, answers: pa.Table) -> pa.Table:
        b = Batch(table, length, groups)
        b.share(_answers(answers, "shared"), _answers(answers, "split"))
        spans = b.removed(_answers(answers, "copies"))
        kept = [b"".join(t[x:y] for x, y in zip([0, *[e for _, e in s]], [*[a for a, _ in s], len(t)], strict=True))
                for t, s in zip(b.texts, spans, strict=True)]
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.table({"doc_id": pa.array(b.ids, pa.int64()), "n_bytes": pa.array([len(t) for t in b.texts], pa.int64()),
                         "spans": pa.array([[{"start": x, "end": y} for x, y in s] for s in spans], pa.list_(span)),
                         "kept": pa.array(kept, pa.binary())})

    asked = dealt.groupBy("batch").applyInArrow(ask, "batch bigint, grp bigint, buckets binary, twice binary, full binary")
    shared = written(asked.groupBy("grp").applyInArrow(share, ANSWER))
    release(spark)
    sent = dealt.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(
        send, "batch bigint, grp bigint, bytes binary, sizes binary, buckets binary, docs binary")
    copies = written(sent.groupBy("grp").applyInArrow(sort, ANSWER))
    release(spark)
    got = dealt.groupBy("batch").cogroup(shared.union(copies).groupBy("batch")).applyInArrow(cut, RESULT)
    without = docs.filter("doc_id is null").select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"),
        F.col("text").cast("binary").alias("kept"))
    return got.union(without)
