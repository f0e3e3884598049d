"""Embedding near-dedup by randomised-rotation binary codes with correction factors.

Each unit vector x is turned by a fixed random rotation P; its code is the sign
of each coordinate of Px, and the stored factor is f = <sign(Px)/sqrt(D), Px>.
For a unit vector q the product <Pq, sign(Px)/sqrt(D)> / f is an unbiased estimate
of the cosine c, and its error never exceeds ``sqrt(1 - f^2) / f * sqrt(1 - c^2)``
(the part of q beside x meets the part of the code beside x).  Only pairs whose
estimate plus that bound at the threshold reaches it are recomputed, exactly
and in double precision; no pair that links is left out.

Candidates are routed exactly at every size.  A label of more than
``BUCKET_ROWS`` vectors gets pivots (vectors of its own, ``PIVOTS`` at most in
the mean); a vector's home is the cell of its nearest pivot.  A linked pair of
homes p and q lies within the threshold's angle of the plane midway between
p and q, so a vector also visits each earlier cell whose midway plane is that
near; each pair of homes meets once, in the earlier cell.  Where the vectors
have no coarse clusters, every earlier cell is visited and every pair of the
label is estimated.  A cell's homes and visitors are dealt into blocks of
``BLOCK`` rows, and each pair of blocks is a group of its own, so that a hot cell is
spread.

Equal vectors of a label are one class with a weight.  Tasks return a link count for each class
and the edges of a spanning forest, never all pairs.

Cases: rows whose label or vector is null, whose vector is empty, all zero, or holds a null or
non-finite component link with nothing, nor do vectors of different lengths;
rows without an id link with nothing and are not kept; rows that repeat
an id count as vectors of their own; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

THRESHOLD = 0.93
BLOCK = 1024
#: Rows of a label for each pivot; a label of so many is one cell.
BUCKET_ROWS = 1024
#: Pivots of a label; beyond that its cells grow.
PIVOTS = 64
#: Rows of a label that are routed at once.
ROUTE_ROWS = 1024
#: Above the rounding errors of products of unit vectors in double precision.
ROUNDING = 1e-7


@functools.lru_cache(maxsize=64)
def rotation(dim: int, number: int) -> np.ndarray:
    """The numbered random rotation of a space; number 0 makes the codes."""
    return np.linalg.qr(np.random.default_rng((dim, number)).standard_normal((dim, dim)))[0]


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign codes (packed bits) and correction factors of unit vectors."""
    turned = unit @ rotation(unit.shape[1], 0)
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(unit.shape[1])


def estimates(left: np.ndarray, codes: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of unit vectors with coded ones, and what each coded vector's error never exceeds
    (at a cosine of c it is at most ``sqrt(1 - c^2)`` of that)."""
    dim = left.shape[1]
    sign = np.unpackbits(codes, axis=1, count=dim).astype(np.float64) * 2 - 1
    estimate = (left @ rotation(dim, 0)) @ sign.T / math.sqrt(dim) / factors
    return estimate, np.sqrt(np.maximum(0, 1 - factors ** 2)) / factors


def _sine(threshold: float) -> float:
    """Of the widest angle of a link."""
    return math.sqrt(1 - threshold ** 2) if 0 <= threshold <= 1 else math.inf if threshold < 0 else 0.0


def _linked(left, right, threshold: float) -> np.ndarray:
    """Pairs (rows of left, rows of right) whose exact cosine reaches the threshold."""
    estimate, bound = estimates(left["unit"], right["code"], right["factor"])
    i, j = np.nonzero(estimate >= threshold - ROUNDING - (bound + ROUNDING) * _sine(threshold))
    found = []
    for k in range(0, len(i), 50_000):
        a, b = i[k:k + 50_000], j[k:k + 50_000]
        x, y = left["vector"][a], right["vector"][b]
        cosine = (x * y).sum(axis=1) / (left["norm"][a] * right["norm"][b])
        found.append(cosine >= threshold)
    hit = np.concatenate(found) if found else np.zeros(0, dtype=bool)
    return np.stack([i[hit], j[hit]], axis=1)


def cells(unit: np.ndarray, pivots: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Each unit vector's home, and a mark for each earlier cell in which it may have links."""
    if not len(pivots):
        return np.zeros(len(unit), dtype=np.int64), np.zeros((len(unit), 1), dtype=bool)
    near = unit @ pivots.T
    home = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T)) + ROUNDING
    beyond = near[np.arange(len(unit)), home][:, None] - near
    visit = beyond <= _sine(threshold) * apart[home] + ROUNDING
    return home, visit & (np.arange(len(pivots)) < home[:, None])


def _forest(pairs: np.ndarray, size: int) -> list[tuple[int, int]]:
    up = list(range(size))
    out = []
    for a, b in pairs.tolist():
        while up[a] != a:
            up[a] = a = up[up[a]]
        while up[b] != b:
            up[b] = b = up[up[b]]
        if a != b:
            up[max(a, b)] = min(a, b)
            out.append((a, b))
    return out


def _vectors(column) -> np.ndarray:
    """A list column of one length as rows of doubles."""
    return pc.list_flatten(column).to_numpy().astype(np.float64).reshape(len(column), -1)


def _side(rows: pa.Table) -> dict:
    vector = _vectors(rows.column("vector"))
    norm = np.sqrt((vector * vector).sum(axis=1))
    return {"vector": vector, "norm": norm, "unit": vector / norm[:, None],
            "code": np.frombuffer(b"".join(rows.column("code").to_pylist()), dtype=np.uint8).reshape(len(vector), -1),
            "factor": rows.column("factor").to_numpy(), "node": rows.column("node").to_numpy(),
            "weight": rows.column("weight").to_numpy()}


def _compare(rows: pa.Table, threshold: float) -> list[tuple]:
    """(node, null, links) and (node, node, null) rows of one pair of blocks."""
    i, j, block = rows.column("i")[0].as_py(), rows.column("j")[0].as_py(), rows.column("block")
    left = rows.filter(pc.equal(block, i))
    right = left if i == j else rows.filter(pc.equal(block, j))
    if not left.num_rows or not right.num_rows:
        return []
    a = _side(left)
    b = a if i == j else _side(right)
    pairs = _linked(a, b, threshold)
    if i == j:
        pairs = pairs[pairs[:, 0] < pairs[:, 1]]
    counts = [np.bincount(pairs[:, 0], weights=b["weight"][pairs[:, 1]], minlength=left.num_rows),
              np.bincount(pairs[:, 1], weights=a["weight"][pairs[:, 0]], minlength=right.num_rows)]
    out = [(int(s["node"][k]), None, int(c[k])) for s, c in zip((a, b), counts, strict=True) for k in np.flatnonzero(c)]
    shift = 0 if i == j else left.num_rows
    nodes = np.concatenate((a["node"], b["node"]))
    return out + [(int(nodes[x]), int(nodes[y]), None)
                  for x, y in _forest(pairs + np.array([0, shift]), len(nodes))]


ROUTED = ("node bigint, label bigint, dim int, vector array<float>, code binary, factor double, weight bigint, "
          "cell int, home boolean")


def _routed(classes: DataFrame, threshold: float) -> DataFrame:
    """Coded vectors, one row for each cell that a vector lives in or visits."""
    classes = classes.withColumn("dim", F.size("vector"))
    sizes = written(classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("rows")).select(
        "label", "dim", F.ceil(F.col("rows") / ROUTE_ROWS).alias("parts"),
        F.when(F.col("rows") > BUCKET_ROWS, F.greatest(F.lit(1), F.ceil(F.col("rows") / F.least(
            F.lit(PIVOTS), F.ceil(F.col("rows") / BUCKET_ROWS))))).alias("each")))
    sized = classes.join(sizes, ["label", "dim"])
    parted = sized.select("label", "dim", F.pmod(F.xxhash64("node"), "parts").alias("part"), "node", "vector", "weight")
    # Any vectors serve as pivots; the choice changes no result.
    pivots = sized.filter(F.pmod(F.xxhash64("node", F.lit("pivot")), "each") == 0).select(
        "label", "dim", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node", "vector").toDF("label", "dim", "part", "node", "vector")

    def route(key, rows: pa.Table, pivots: pa.Table) -> pa.Table:
        unit = lambda x: x / np.sqrt((x * x).sum(axis=1))[:, None]
        dim = key[1].as_py()
        own = unit(_vectors(rows.column("vector"))) if rows.num_rows else np.zeros((0, dim))
        pivots = pivots.sort_by("node")
        home, visit = cells(own, unit(_vectors(pivots.column("vector"))) if pivots.num_rows else own[:0], threshold)
        guest, cell = np.nonzero(visit)
        code, factor = encode(own)
        at = np.concatenate((np.arange(len(own)), guest))
        taken = rows.take(pa.array(at))
        return pa.table({
            "node": taken.column("node"), "label": taken.column("label"), "dim": pa.array([dim] * len(at), pa.int32()),
            "vector": taken.column("vector"), "code": pa.array([code[k].tobytes() for k in at], pa.binary()),
            "factor": pa.array(factor[at], pa.float64()), "weight": taken.column("weight"),
            "cell": pa.array(np.concatenate((home, cell)), pa.int32()), "home": pa.array(np.arange(len(at)) < len(own))})

    group = ["label", "dim", "part"]
    return parted.groupBy(*group).cogroup(pivots.groupBy(*group)).applyInArrow(route, ROUTED)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id",
                    embedding: str = "embedding", label: str = "label") -> DataFrame:
    """One row ``vec_id, n_links, component_id, kept`` for each row of ``vectors``."""
    vector = F.col("vector")
    fit = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull()
           & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
           & F.exists(vector, lambda x: x != 0))
    rows = written(vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"),
        F.col(embedding).cast("array<float>").alias("vector"))
        .withColumn("digest", F.when(F.coalesce(fit, F.lit(False)), F.sha1(F.concat_ws(
            ",", F.col("label").cast("string"), F.transform(vector, lambda x: x.cast("string")))))))
    fitting = rows.filter("digest is not null")
    classes = fitting.groupBy("digest").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first_id"),
                                            F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()))
    routed = written(_routed(classes.select("node", "label", "vector", "weight"), threshold))

    # A cell's homes fill the first blocks, its visitors the others; visitors don't meet each other.
    cell = ["label", "dim", "cell"]
    blocks = written(routed.groupBy(*cell).agg(F.ceil(F.count_if("home") / BLOCK).alias("own"),
                                               F.ceil(F.count_if(~F.col("home")) / BLOCK).alias("guests")).filter("own > 0"))
    last = F.when(F.col("home"), F.col("own") + F.col("guests")).otherwise(F.col("own")) - 1
    place = F.xxhash64("node")
    dealt = routed.join(blocks, cell).withColumn(
        "block", F.when(F.col("home"), F.pmod(place, "own")).otherwise(F.col("own") + F.pmod(place, "guests"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0), last)))
    group = ["bucket", *cell, "i", "j"]
    dealt = dealt.select(F.xxhash64(*cell).alias("bucket"), *cell, F.least("block", "other").alias("i"),
                         F.greatest("block", "other").alias("j"), "block", "node", "vector", "code", "factor", "weight")

    def run(batches):
        held, current = [], None

        def done():
            out = _compare(pa.Table.from_batches(held), threshold) if sum(len(b) for b in held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)],
                                              names=["a", "b", "n"])

        for batch in batches:
            own = np.stack([batch.column(c).to_numpy() for c in group], axis=1)
            edges = [0, *(np.flatnonzero((own[1:] != own[:-1]).any(axis=1)) + 1).tolist(), len(own)]
            for x, y in zip(edges, edges[1:], strict=False):
                if y > x:
                    if (key := tuple(own[x].tolist())) != current:
                        yield done()
                        held, current = [], key
                    held.append(batch.slice(x, y - x))
        yield done()

    found = written(dealt.repartitionByRange("bucket", "i", "j").sortWithinPartitions(*group)
                    .mapInArrow(run, "a bigint, b bigint, n bigint"))
    near = components(found.filter("b is not null").select("a", "b"))
    counts = found.filter("n is not null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    named = written(classes.select("node", "digest", "weight", "first_id").join(near, "node", "left")
                    .withColumn("label", F.coalesce("label", "node")))
    first = written(named.groupBy("label").agg(F.min("first_id").alias("component_id")))
    known = (named.join(first, "label").join(written(counts), "node", "left")
             .select("digest", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"))
    got = rows.select("vec_id", "digest").join(written(known), "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return got.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
