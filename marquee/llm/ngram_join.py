"""N-gram Jaccard join: blocked sparse matrix product of documents by n-grams.

A document's set holds its distinct runs of ``words`` words (fewer words: the
whole sequence); two documents link when ``den * |A & B| >= num * |A | B|``.
The result is the documents' connected components, found without emitting the
pairs within a group:

1. Sets.  Shingles are 64-bit hashes; equal sets are one class, so copies cost
   one row each.
2. Blocking by size-derived bounds.  Linked sets of sizes a <= b differ in at
   most ``(a + b) * (den - num) / (den + num)`` shingles.  Shingles are dealt by
   hash into more parts than that, so linked sets agree on a whole part
   (exactly, not by chance).  A part's signature is its sum of hashes.  The
   number of parts follows the size: sizes are cut into intervals, and a set
   also signs for the interval below if it may link into it.  There are E parts
   more than needed, so parts of fewer than three shingles, which many
   documents share by chance, are left out by documents with at most E of them.
   Linked sets share several signatures (the spare parts but for those left
   out), so each set then drops as many of its most used ones as it can spare:
   in order of their use, two sets' common signatures can't all be among those.
3. Clusters.  Each kept signature's smallest class is joined to its other
   classes (a star, not all pairs); the stars' components hold all links.
   Clusters of more than ``block`` classes are refined by the incidence of their
   classes and n-grams: linked sets of size n share ceil(n * num / den) n-grams or
   more, so a class with fewer that any other class of its cluster holds goes, and
   of the others only the rarest n-grams count, as many as make two linked sets
   meet in one of them; their stars make the new, smaller clusters.
4. Product.  A cluster's documents by n-grams form a sparse 0/1 matrix; its
   product with its transpose, accumulated over blocks of columns, gives the
   overlap counts; pairs below the bound are dropped.  A cluster of more than
   ``block`` documents is dealt into row blocks: each block is multiplied with
   itself and the first block; where a cluster then still has several
   components, every pair of row blocks that may join two of them is multiplied.

Cases: null texts and texts without words have an empty set and link with
nothing; rows without an id link with nothing (their component is null);
repeated rows are each answered; rows that share an id but not a text are
told apart by their sets.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import array_chunks, arrow_column, binary_array, broadcast_if_few, drop_made, release, utf8_views, written
from .components import components

BLOCK, BLOCK_SHINGLES = 64, 1_000_000
SECOND_BLOCK = 512
#: Columns of the product that are multiplied at once.
COLUMNS = 16_384
#: Bytes of text whose sets a task holds at once.
SET_CHUNK = 256 << 10
#: Shingles of the sets that a task signs for at once, and signatures of a bucket on average.
DEALT_SHINGLES, BUCKET_SIGNS = 1_000_000, 500_000
#: Signatures of a bucket that a task holds before it looks for repeated ones.
MERGED_SIGNS = 2_000_000
#: Classes of a run whose n-grams are dealt together (their places fit 16 bits), and rows that a task hands on at once.
RUN_CLASSES, SHARED_ROWS = 1 << 16, 100_000
#: A greater least number of shared signatures counts as this one (more are kept then).
LEAST = 16_383
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that scatters them (splitmix64's finisher)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_sets(batch: list[bytes], k: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; a word is a run without ASCII white space, A-Z as a-z."""
    number: dict[bytes, int] = {}
    rows = [[number.setdefault(w, len(number)) for w in t.lower().split()] for t in batch]
    if not number:
        return [np.zeros(0, _U) for _ in batch]
    digest = np.fromiter(map(xxhash.xxh3_64_intdigest, number), dtype=_U, count=len(number))
    out = []
    for own in rows:
        if not own:
            out.append(np.zeros(0, _U))
            continue
        h = digest[np.array(own)]
        n = max(1, len(h) - k + 1)
        x = np.full(n, min(k, len(h)), dtype=_U)
        for j in range(min(k, len(h))):
            x = mix(x * _U(0x9E3779B97F4A7C15) + h[j:j + n])
        out.append(np.unique(x))
    return out


@functools.lru_cache(maxsize=100_000)
def instances(n: int, num: int, den: int) -> list[tuple[int, int, int, int]]:
    """(interval, parts, spare parts, least size of a part that isn't thin) for which a set of n shingles signs."""
    if n == 0:  # an empty set links with nothing
        return []
    # Intervals of sizes are as wide as a few steps from a set to its largest partner, at most about 1.4 to 1.
    steps = max(1, int(math.log(1.4) / math.log(den / num)))
    low, interval, below, found = 1, 0, None, []
    while True:
        high = low * den ** steps // num ** steps + 1  # sizes of this interval: low .. high - 1
        a = high - 1
        differ = (a + a * den // num) * (den - num) // (den + num)
        # Thick parts are rarely shared by chance; thin ones need more spare parts to be left out.
        thick = low >= 6 * (differ + 1)
        spare, least = (differ // 8, 3) if thick else (differ, 2)
        here = (interval, differ + 1 + spare, spare, least) if differ else None
        if low <= n < high:
            found = [here] if here else []
            # A smaller partner may stand in the interval below.
            if below and n <= (low - 1) * den // num:
                found.append(below)
            return found
        low, interval, below = high, interval + 1, here


def signatures(shingles: np.ndarray, num: int, den: int) -> list[tuple[int, int, np.ndarray]]:
    """For each instance: its interval, the least number of its signatures that a linked set shares, and them."""
    out = []
    for interval, parts, spare, least in instances(len(shingles), num, den):
        salt = mix(np.array([interval + 1], dtype=_U) * _U(0x9E3779B97F4A7C15))
        part = ((mix(shingles ^ salt) >> _U(16)) % _U(parts)).astype(np.int64)
        size = np.bincount(part, minlength=parts)
        total = np.zeros(parts, dtype=_U)
        np.add.at(total, part, mix(shingles + salt))
        sign = mix(total + mix(np.arange(parts, dtype=_U) + salt))
        thin = size < least
        left_out = int(thin.sum())
        # Linked sets agree on more than ``spare`` parts; those left out here are all that may be missing.
        if left_out <= spare:
            out.append((interval, spare + 1 - left_out, sign[~thin]))
        else:
            out.append((interval, 1, sign))
    return out


def _identity(shingles: np.ndarray) -> tuple[int, int]:
    first = mix(shingles).sum(dtype=_U) + _U(len(shingles))
    second = mix(shingles ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=_U)
    return int(np.int64(first.astype(np.int64))), int(second.astype(np.int64))


def _sets(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Each row's set: its size, the class of equal sets, and for how many signatures it is good at most."""

    def run(batches):
        drop_made()
        for batch in batches:
            at = 0
            for part in array_chunks(batch.column("text"), SET_CHUNK):
                sets = shingle_sets(utf8_views(part), words)
                same = [_identity(s) if len(s) else (None, None) for s in sets]
                signs = [sum(parts for _, parts, _, _ in instances(len(s), num, den)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([a for a, _ in same], pa.int64()), pa.array([b for _, b in same], pa.int64()),
                     pa.array(signs, pa.int64())], names=["doc_id", "n", "h", "h2", "signs"])
                at += len(part)
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, "doc_id bigint, n bigint, h bigint, h2 bigint, signs bigint")


def _by_bucket(sign: np.ndarray, buckets: int, *beside: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """The buckets used, and for each the signs' low halves and what stands beside them, as binary arrays."""
    bucket = ((sign & _U((buckets << 32) - 1)) >> _U(32)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    used, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts, len(order))
    return used, [binary_array([x[order].view(np.uint8)], np.diff(ends) * x.itemsize)
                  for x in (sign.astype(np.uint32), *beside)]


def _dealt_signatures(docs: DataFrame, words: int, num: int, den: int, buckets: int) -> DataFrame:
    """The signatures of the documents' sets, dealt by sign into ``buckets`` (a power of two).

    A row holds what a run of documents has in one bucket, as arrays side by side: the signs' low halves,
    the classes, and their instances (least number of shared signatures, doubled; odd: of the interval below)."""

    cells = _U((buckets << 32) - 1)

    def dealt(sets: dict[int, np.ndarray]) -> pa.RecordBatch:
        signed = []
        for h, s in sets.items():
            for i, (_, least, sign) in enumerate(signatures(s, num, den)):
                # Signs of one set that fall together count once, so as many fewer are sure to be shared.
                least -= len(sign) - len(np.unique(sign & cells))
                signed.append((h, 2 * min(max(least, 1), LEAST) + i, sign))
        sizes = [len(sign) for _, _, sign in signed]
        sign = np.concatenate([x[2] for x in signed]) if signed else np.zeros(0, _U)
        beside = (np.repeat(np.array([x[0] for x in signed], np.int64), sizes),
                  np.repeat(np.array([x[1] for x in signed], np.int16), sizes))
        used, columns = _by_bucket(sign, buckets, *beside)
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *columns],
                                          names=["bucket", "low", "h", "instance"])

    def run(batches):
        drop_made()
        held, size = {}, 0
        for batch in batches:
            for part in array_chunks(batch.column("text"), SET_CHUNK):
                for s in shingle_sets(utf8_views(part), words):
                    if len(s) and (h := _identity(s)[0]) not in held:
                        held[h] = s
                        size += len(s)
                if size >= DEALT_SHINGLES:
                    yield dealt(held)
                    held, size = {}, 0
            pa.default_memory_pool().release_unused()
        yield dealt(held)

    return docs.mapInArrow(run, "bucket int, low binary, h binary, instance binary")


def _shared_signatures(dealt: DataFrame) -> DataFrame:
    """``h, instance, sign, uses``: the signatures that several classes have, and how many have them."""

    def distinct(low, h, instance):
        order = np.lexsort((instance, h, low))
        low, h, instance = low[order], h[order], instance[order]
        new = np.ones(len(low), dtype=bool)
        new[1:] = (low[1:] != low[:-1]) | (h[1:] != h[:-1]) | (instance[1:] != instance[:-1])
        return low[new], h[new], instance[new]

    def shared(bucket, held):
        low, h, instance = distinct(*map(np.concatenate, zip(*held, strict=True)))
        starts = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        uses = np.diff(np.append(starts, len(low)))
        uses = np.repeat(uses, uses)
        keep = uses > 1
        sign = (np.int64(bucket) << 32) | low[keep].astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(h[keep]), pa.array(instance[keep]), pa.array(sign), pa.array(uses[keep].astype(np.int32))],
            names=["h", "instance", "sign", "uses"])

    def run(batches):
        group, held, size, limit = None, [], 0, MERGED_SIGNS
        for batch in batches:
            for bucket, *own in zip(batch.column("bucket").to_pylist(),
                                    *[batch.column(c) for c in ("low", "h", "instance")], strict=True):
                if bucket != group:
                    if held:
                        yield shared(group, held)
                    group, held, size, limit = bucket, [], 0, MERGED_SIGNS
                held.append(tuple(np.frombuffer(x.as_buffer(), kind)
                                  for x, kind in zip(own, (np.uint32, np.int64, np.int16), strict=True)))
                size += len(held[-1][0])
                # Copies of a text that many tasks signed for fall together before they pile up.
                if size > limit:
                    held = [distinct(*map(np.concatenate, zip(*held, strict=True)))]
                    size = len(held[0][0])
                    limit = max(MERGED_SIGNS, 2 * size)
        if held:
            yield shared(group, held)

    rows = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(run, "h bigint, instance smallint, sign bigint, uses int")


def class_of(text: Column, words: int) -> Column:
    """The class ``h`` of a text, null without words."""
    return arrow_column(functools.partial(_classes, words=words), "bigint")(text)


def _classes(batch: pa.Array, words: int) -> pa.Array:
    drop_made()
    found = [_identity(s)[0] if len(s) else None for part in array_chunks(batch, SET_CHUNK)
             for s in shingle_sets(utf8_views(part), words)]
    pa.default_memory_pool().release_unused()
    return pa.array(found, pa.int64())


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of all pairs: the incidence matrix times its transpose, by blocks of columns."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = uses > 1
    number = np.cumsum(keep) - 1
    shared = keep[column]
    rows, column = rows[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    counts = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for first in range(0, int(keep.sum()), COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        block = np.zeros((len(sets), int(column[b - 1]) - first + 1), dtype=np.float32)
        block[rows[a:b], column[a:b] - first] = 1
        counts += block @ block.T
    return counts.astype(np.int64)


def links_within(ids: list[int], sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Edges that join the members of each linked group to its first member."""
    n = np.array([len(s) for s in sets])
    common = overlaps(sets)
    linked = den * common >= num * (n[:, None] + n[None, :] - common)
    left, out = np.ones(len(ids), dtype=bool), []
    for first in range(len(ids)):
        if not left[first]:
            continue
        left[first] = False
        front = linked[first] & left
        while front.any():
            left &= ~front
            out += [(ids[first], ids[k]) for k in np.flatnonzero(front)]
            front = linked[front].any(axis=0) & left
    return out


def _multiply(rows: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Edges found in each task's documents; ``rows`` has columns cluster, task, h, text."""

    def run(batches):
        held, group = {}, None

        def done():
            if len(held) < 2:
                return None
            sets = shingle_sets(list(held.values()), words)
            # A row that shares its id with another text is not the class that was asked for.
            own = [(h, s) for h, s in zip(held, sets, strict=True) if len(s) and _identity(s)[0] == h]
            found = links_within([h for h, _ in own], [s for _, s in own], num, den) if len(own) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())],
                names=["a", "b"]) if found else None

        for batch in batches:
            for key, h, text in zip(zip(batch.column("cluster").to_pylist(), batch.column("task").to_pylist(), strict=True),
                                    batch.column("h").to_pylist(), utf8_views(batch.column("text")), strict=True):
                if key != group:
                    if (out := done()) is not None:
                        yield out
                    held, group = {}, key
                if h not in held or _identity(shingle_sets([text], words)[0])[0] == h:
                    held[h] = text
        if (out := done()) is not None:
            yield out

    # Ranges of (cluster, task): whole groups of bounded size, evenly many rows in a partition.
    dealt = rows.repartitionByRange("cluster", "task").sortWithinPartitions("cluster", "task", "h")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def _candidates(docs: DataFrame, sets: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Edges a, b whose components hold all links (see steps 2 and 3 of the method)."""
    spark = sets.sparkSession
    signs = sets.filter("doc_id is not null").agg(F.sum("signs")).first()[0] or 0
    dealt = _dealt_signatures(docs.filter("doc_id is not null").select("text"), words, num, den,
                              1 << (signs // BUCKET_SIGNS).bit_length())
    met = written(_shared_signatures(dealt))
    release(spark)
    # Linked sets share ``least`` signatures or more, so each can do without its least - 1 most used ones:
    # those that chance and common passages make documents share.
    own = met.groupBy("h", "instance").agg(F.array_sort(F.collect_list(F.struct("uses", "sign"))).alias("own"))
    own = own.withColumn("least", F.expr("instance div 2").cast("int"))
    kept = written(own.filter(F.size("own") >= F.col("least")).select(
        "h", F.explode(F.slice("own", F.lit(1), F.size("own") - F.col("least") + 1)).alias("s")).select("h", "s.sign"))
    first = written(kept.groupBy("sign").agg(F.min("h").alias("a"), F.max("h").alias("z")).filter("a < z").select("sign", "a"))
    return written(kept.join(first, "sign").filter("a <> h").select("a", F.col("h").alias("b")).distinct())


def _dealt_grams(rows: DataFrame, words: int, num: int, den: int, buckets: int) -> DataFrame:
    """The n-grams of rows cluster, h, text, dealt by a hash of cluster and n-gram into ``buckets`` (a power of two);
    rows whose text is not of the class they ask for are left out.

    A row holds what a run of classes has in one bucket, as arrays side by side: the hashes' low halves, and the
    classes' places in the run.  One row (``classes``) for each run lists its classes instead, and how many n-grams
    each must share to be linked."""

    cells = _U((buckets << 32) - 1)

    def dealt(held: dict[int, tuple[int, np.ndarray]]) -> pa.RecordBatch:
        own = [np.unique(mix(s ^ mix(np.array([cluster]).view(_U))) & cells) for cluster, s in held.values()]
        # N-grams of one set that fall together count once, so as many fewer are sure to be shared.
        least = [max(1, -(-len(s) * num // den) - len(s) + len(x)) for (_, s), x in zip(held.values(), own, strict=True)]
        h = np.array(list(held), np.int64)
        run = int(mix(h.view(_U) + mix(np.arange(len(h), dtype=_U))).sum(dtype=_U).astype(np.int64))
        place = np.repeat(np.arange(len(h), dtype=np.uint16), [len(x) for x in own])
        used, (low, place) = _by_bucket(np.concatenate(own), buckets, place)
        rows = len(used)
        return pa.RecordBatch.from_arrays(
            [pa.array([*used, run % buckets], pa.int32()), pa.array([run] * (rows + 1), pa.int64()),
             pa.array([False] * rows + [True]), pa.array([*low.to_pylist(), h.tobytes()], pa.binary()),
             pa.array([*place.to_pylist(), np.array(least, np.int32).tobytes()], pa.binary())],
            names=["bucket", "run", "classes", "low", "place"])

    def run(batches):
        drop_made()
        held, size = {}, 0
        for batch in batches:
            at = 0
            for part in array_chunks(batch.column("text"), SET_CHUNK):
                asked = zip(*[batch.column(c).slice(at, len(part)).to_pylist() for c in ("h", "cluster")], strict=True)
                for (h, cluster), s in zip(asked, shingle_sets(utf8_views(part), words), strict=True):
                    if len(s) and h not in held and _identity(s)[0] == h:
                        held[h] = (cluster, s)
                        size += len(s)
                    if size >= DEALT_SHINGLES or len(held) == RUN_CLASSES:
                        yield dealt(held)
                        held, size = {}, 0
                at += len(part)
            pa.default_memory_pool().release_unused()
        if held:
            yield dealt(held)

    return rows.mapInArrow(run, "bucket int, run bigint, classes boolean, low binary, place binary")


def _shared_grams(dealt: DataFrame) -> DataFrame:
    """``run, place, g, uses``: the n-grams that several classes have, and how many have them;
    ``run, place, h, least``: the classes."""

    names = ["run", "place", "h", "least", "g", "uses"]

    def shared(bucket, held):
        low, place = (np.concatenate(x) for x in list(zip(*held, strict=True))[1:])
        run = np.repeat(np.arange(len(held)), [len(x[1]) for x in held])
        order = np.argsort(low, kind="stable")
        ordered = low[order]
        uses = np.diff(np.append(np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))), len(low)))
        uses = np.repeat(uses, uses)
        keep = np.flatnonzero(uses > 1)
        runs = np.array([x[0] for x in held], np.int64)
        for first in range(0, len(keep), SHARED_ROWS):
            some = keep[first:first + SHARED_ROWS]
            at, none = order[some], pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(runs[run[at]]), pa.array(place[at].astype(np.int32)), none, none.cast(pa.int32()),
                 pa.array((np.int64(bucket) << 32) | ordered[some].astype(np.int64)), pa.array(uses[some].astype(np.int32))],
                names=names)

    def run(batches):
        group, held = None, []
        for batch in batches:
            for bucket, run, classes, low, place in zip(*[batch.column(c).to_pylist() for c in ("bucket", "run", "classes")],
                                                        batch.column("low"), batch.column("place"), strict=True):
                if bucket != group:
                    if held:
                        yield from shared(group, held)
                    group, held = bucket, []
                if classes:
                    h = np.frombuffer(low.as_buffer(), np.int64)
                    none = pa.nulls(len(h), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(h), run)), pa.array(np.arange(len(h), dtype=np.int32)), pa.array(h),
                         pa.array(np.frombuffer(place.as_buffer(), np.int32)), none, none.cast(pa.int32())], names=names)
                else:
                    held.append((run, np.frombuffer(low.as_buffer(), np.uint32), np.frombuffer(place.as_buffer(), np.uint16)))
        if held:
            yield from shared(group, held)

    rows = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(run, "run bigint, place int, h bigint, least int, g bigint, uses int")


def _rarest_shared(rows: DataFrame, grams: int, words: int, num: int, den: int) -> DataFrame:
    """Edges a, b between classes that share one of their rarest n-grams; ``rows`` has columns cluster, h, text,
    and their sets hold some ``grams`` n-grams in all."""
    met = _shared_grams(_dealt_grams(rows, words, num, den, 1 << (grams // BUCKET_SIGNS).bit_length()))
    shared = F.when(F.col("uses").isNotNull(), F.struct("uses", "g"))
    own = met.groupBy("run", "place").agg(F.max("h").alias("h"), F.max("least").alias("least"),
                                          F.array_sort(F.collect_list(shared)).alias("own"))
    kept = written(own.filter("size(own) >= least").select(
        "h", F.explode(F.slice("own", F.lit(1), F.size("own") - F.col("least") + 1)).alias("x")).select("h", "x.g"))
    release(rows.sparkSession)
    first = written(kept.groupBy("g").agg(F.min("h").alias("a"), F.max("h").alias("z")).filter("a < z").select("g", "a"))
    return kept.join(first, "g").filter("a <> h").select("a", F.col("h").alias("b")).distinct()


def _refined(docs: DataFrame, cluster: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``cluster`` (cluster, h, doc_id, n) with its large clusters cut down; no link is lost.

    Repeated while a round takes a tenth or more of the classes in large clusters:
    a class that goes makes its n-grams rarer in the others."""
    spark, before = docs.sparkSession, None
    release(spark)
    while True:
        sizes = written(cluster.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") > BLOCK))
        large = written(cluster.join(sizes.select("cluster"), "cluster", "left_semi"))
        rows, grams = large.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if rows == 0 or before is not None and rows * 10 > before * 9:
            return cluster
        before = rows
        texts = _with_text(docs, large.select("cluster", "h", "doc_id")).select("cluster", "h", "text")
        edges = _rarest_shared(texts, grams, words, num, den)
        near = components(edges).select(F.col("node").alias("h"), F.col("label").alias("new"))
        cluster = written(cluster.join(sizes.select("cluster"), "cluster", "left_anti").unionByName(
            large.join(near, "h").select(F.col("new").alias("cluster"), "h", "doc_id", "n")))
        release(spark)


def _with_text(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with the texts of its doc_id."""
    return docs.join(broadcast_if_few(wanted), "doc_id")


def join(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10, doc_id: str = "doc_id",
         text: str = "text", classes_too: bool = False) -> DataFrame:
    """One row ``doc_id, n_shingles, component_id`` (and ``h``, the class of equal sets, if asked) for each row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets = written(_sets(docs, words, num, den))

    star_edges = _candidates(docs, sets, words, num, den)
    near = components(star_edges)

    classes = (sets.filter("doc_id is not null and h is not null").groupBy("h")
               .agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n")))
    cluster = written(classes.join(near.withColumnRenamed("node", "h"), "h")
                      .select(F.col("label").alias("cluster"), "h", "doc_id", "n"))
    cluster = _refined(docs, cluster, words, num, den)
    sizes = (cluster.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"))
             .select("cluster", F.greatest(F.ceil(F.col("docs") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
                     .alias("blocks")))
    placed = written(cluster.join(written(sizes), "cluster").withColumn("row_block", F.pmod(F.xxhash64("h"), "blocks")))
    # The first block of rows is multiplied with every block.
    tasks = F.when(F.col("row_block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
        F.array("row_block"))
    first = written(_multiply(_with_text(docs, placed.select("cluster", "h", "doc_id", "blocks", "row_block"))
                              .select("cluster", F.explode(tasks).alias("task"), "h", "text"), words, num, den))
    links = first
    large = placed.filter("blocks > 1")
    if not large.isEmpty():
        links = links.union(_second_round(docs, large, components(first), words, num, den))
    found = components(links).withColumnRenamed("node", "h")

    linked = written(classes.join(found, "h").select("h", "label", "doc_id"))
    smallest = written(linked.groupBy("label").agg(F.min("doc_id").alias("component_id")))
    by_class = linked.join(smallest, "label").select("h", "component_id")
    copies = classes.select("h", F.col("doc_id").alias("first_copy"))
    known = copies.join(by_class, "h", "left").select("h", F.coalesce("component_id", "first_copy").alias("component_id"))
    own = sets.select("doc_id", F.col("n").alias("n_shingles"), "h")
    return own.join(written(known), "h", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        *["h"] * classes_too)


def _second_round(docs: DataFrame, large: DataFrame, found: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Links between row blocks of clusters that the first round left in several components."""
    member = written(large.select("cluster", "h", "doc_id", "n").join(found.withColumnRenamed("node", "h"), "h", "left")
                     .withColumn("part", F.coalesce("label", "h")).drop("label"))
    parts = written(member.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles")))
    whole = parts.groupBy("cluster").agg(F.count(F.lit(1)).alias("parts"), F.sum("docs").alias("all_docs"),
                                         F.sum("shingles").alias("all_shingles")).filter("parts > 1")
    blocks = lambda d, s: F.greatest(F.ceil(F.col(d) / SECOND_BLOCK), F.ceil(F.col(s) / BLOCK_SHINGLES))
    parts = written(parts.join(written(whole), "cluster").select(
        "cluster", "part", F.when(F.col("docs") * 2 >= SECOND_BLOCK, F.col("part")).alias("own"),
        blocks("docs", "shingles").alias("own_blocks"), blocks("all_docs", "all_shingles").alias("mixed_blocks")))
    # A large component fills row blocks of its own; small ones share blocks.
    at = member.join(parts, ["cluster", "part"]).select(
        "cluster", "h", "doc_id", "own",
        F.when(F.col("own").isNotNull(), F.xxhash64("own", F.pmod(F.xxhash64("h"), "own_blocks")))
        .otherwise(F.pmod(F.xxhash64("part"), "mixed_blocks")).alias("row_block"))
    at = written(at)
    listed = written(at.groupBy("cluster", "row_block").agg(F.max("own").alias("own")))
    i, j = listed.toDF("cluster", "i", "own_i"), listed.toDF("cluster", "j", "own_j")
    pairs = i.join(j, "cluster").filter("i < j and not (own_i <=> own_j and own_i is not null) or i = j and own_i is null")
    pairs = written(pairs.select("cluster", "i", "j", F.xxhash64("cluster", "i", "j").alias("task")))
    used = pairs.select("cluster", F.col("i").alias("row_block"), "task").union(
        pairs.select("cluster", F.col("j").alias("row_block"), "task")).distinct()
    rows = at.join(used, ["cluster", "row_block"]).select("cluster", "task", "h", "doc_id")
    return written(_multiply(_with_text(docs, written(rows)).select("cluster", "task", "h", "text"), words, num, den))
