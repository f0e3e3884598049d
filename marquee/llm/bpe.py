"""Byte-level BPE encoding and decoding from a file of ranks.

A text is split into pre-tokens by a pattern.  A pre-token that is itself in
the vocabulary is answered by a minimal perfect hash (one slot for each of the
n tokens, checked against the stored bytes).  A miss is merged bottom up: its
bytes are a doubly linked list, a heap holds the adjacent pairs by (rank,
place), and the lowest pair is merged until none is in the vocabulary.

Cases: a null text is encoded as an empty one; an empty text has no ids; equal
texts get equal ids; special-token strings are ordinary text; one pre-token of
any length costs n log n.  Ids outside the vocabulary can't be decoded and
raise ``KeyError``.  Other columns are kept; a column with the output's name
is replaced.
"""

from __future__ import annotations

import base64
import functools
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PieceTable, arrow_column, binary_array, made_once, text_chunks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Distinct pre-tokens whose ids a worker remembers; the memory is emptied when it is full.
REMEMBERED = 300_000


_GOLDEN, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


class PerfectHash:
    """Minimal perfect hash by hash and displace: bucket -> displacement -> slot.

    The keys of a bucket are hashed anew for d = 0, 1, ... until all of them
    fall on free slots, large buckets first; a bucket of one key names its
    slot outright (stored as ``-slot - 1``).
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = max(1, len(keys))
        self.buckets = max(1, n // 2)
        digests = self.digests(keys)
        members: dict[int, list[int]] = {}
        for k, at in enumerate(self._bucket(digests).tolist()):
            members.setdefault(at, []).append(k)
        self.place = np.zeros(self.buckets, dtype=np.int64)
        self.key_at = np.full(n, -1, dtype=np.int64)
        taken, free = np.zeros(n, dtype=bool), 0
        for at, own in sorted(members.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(own) == 1:
                while taken[free]:
                    free += 1
                d, to = -free - 1, np.array([free])
            else:
                d, to = self._fit(digests[own], taken)
            self.place[at], taken[to], self.key_at[to] = d, True, own

    def _fit(self, h: np.ndarray, taken: np.ndarray) -> tuple[int, np.ndarray]:
        first = 0
        while True:
            to = self._slot(h[None, :], np.arange(first, first + 64, dtype=np.uint64)[:, None])
            ordered = np.sort(to, axis=1)
            fits = ~taken[to].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if fits.any():
                d = int(np.argmax(fits))
                return first + d, to[d]
            first += 64

    @staticmethod
    def digests(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys))

    def _bucket(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)

    def _slot(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        x = h + d * np.uint64(_GOLDEN)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(_MIX)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(self.n)).astype(np.int64)

    def lookup(self, keys: list[bytes]) -> np.ndarray:
        """The number of the only key that each may be; the caller compares the bytes."""
        h = self.digests(keys)
        d = self.place[self._bucket(h)]
        return self.key_at[np.where(d < 0, -d - 1, self._slot(h, np.maximum(d, 0).astype(np.uint64)))]


class Codec:
    def __init__(self, ranks: bytes, pattern: str, built: PerfectHash | None = None):
        pairs = [(base64.b64decode(k), int(v)) for k, v in (line.split() for line in ranks.splitlines() if line)]
        self.rank = dict(pairs)
        self.tokens = [k for k, _ in pairs]
        self.values = [v for _, v in pairs]
        self.bytes_of = {v: k for k, v in pairs}
        self.hash = built or PerfectHash(self.tokens)
        self.pattern = regex.compile(pattern)
        self.table = PieceTable(self._solve, REMEMBERED)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is not in the vocabulary."""
        rank, n = self.rank.get, len(piece)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapify(heap)
        alive = bytearray(b"\1") * (n + 1)
        while heap:
            _, i, size = heappop(heap)
            j = after[i]
            # A part that was merged away, or one that has grown since.
            if not alive[i] or j >= n or after[j] - i != size:
                continue
            k = after[i] = after[j]
            alive[j] = 0
            before[k] = i
            if k < n and (r := rank(piece[i:after[k]])) is not None:
                heappush(heap, (r, i, after[k] - i))
            if (p := before[i]) >= 0 and (r := rank(piece[p:k])) is not None:
                heappush(heap, (r, p, k - p))
        out, i = [], 0
        while i < n:
            out.append(rank(piece[i:after[i]]))
            i = after[i]
        return out

    def _solve(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [p.encode() for p in pieces]
        flat: list[int] = []
        width = np.ones(len(raw), dtype=np.int64)
        for k, (piece, at) in enumerate(zip(raw, self.hash.lookup(raw).tolist(), strict=True)):
            if self.tokens[at] == piece:
                flat.append(self.values[at])
            else:
                got = self.merge(piece)
                width[k] = len(got)
                flat += got
        return np.array(flat, dtype=np.int32), width

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the batch in order, and the number of each text's."""
        self.table.make_room()
        rows = [self.pattern.findall(text) for text in batch]
        return self.table.ids(rows, np.fromiter(map(len, rows), dtype=np.int64, count=len(rows)))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def _codec(sent, key) -> Codec:
    return made_once("codec", sent, lambda value: Codec(*value), key)


def _sent(spark, ranks_path: str, pattern: str):
    """The rank file and its hash (1 MB each for 50,000 tokens) go to the executors."""
    with open(ranks_path, "rb") as f:
        ranks = f.read()
    if len(ranks) > 64 << 20:
        raise ValueError(f"{ranks_path}: a vocabulary of {len(ranks)} bytes is not broadcast")
    key = (pattern, xxhash.xxh3_64_hexdigest(ranks))
    return spark.sparkContext.broadcast((ranks, pattern, _built(ranks))), key


@functools.lru_cache(maxsize=2)
def _built(ranks: bytes) -> PerfectHash:
    return PerfectHash([base64.b64decode(line.split()[0]) for line in ranks.splitlines() if line])


def encode(df: DataFrame, text: str = "text", out: str = "ids", decoded: str | None = None,
           ranks_path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with column ``out``: the ids of ``text`` as little-endian unsigned 32-bit integers (binary).

    ``decoded`` names a column for the bytes that the ids decode to, made in
    the same pass over the batch (``decode`` does so for stored ids)."""
    sent, key = _sent(df.sparkSession, ranks_path, pattern)

    def kernel(batch: pa.Array) -> pa.Array:
        codec, parts, counts, back, lengths = _codec(sent, key), [], [np.zeros(0, np.int64)], [], []
        for chunk in text_chunks(batch):
            ids, sizes = codec.encode(chunk)
            parts.append(ids.astype("<u4"))
            counts.append(4 * sizes)
            if decoded:
                ends = np.cumsum(sizes).tolist()
                own = [codec.decode(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
                back.append(np.frombuffer(b"".join(own), dtype=np.uint8))
                lengths += map(len, own)
        found = [binary_array(parts, np.concatenate(counts))]
        if decoded:
            found.append(binary_array(back, np.array(lengths, dtype=np.int64)))
        pa.default_memory_pool().release_unused()
        return pa.StructArray.from_arrays(found, names=["ids", "decoded"][:len(found)])

    kind = "struct<ids:binary,decoded:binary>" if decoded else "struct<ids:binary>"
    got = df.withColumn("__e", arrow_column(kernel, kind)(F.col(text))).withColumn(out, F.col("__e.ids"))
    return (got.withColumn(decoded, F.col("__e.decoded")) if decoded else got).drop("__e")


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", ranks_path: str = RANKS,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with column ``out``: the bytes that ``ids`` (as ``encode`` makes them) stand for."""
    sent, key = _sent(df.sparkSession, ranks_path, pattern)

    def kernel(batch: pa.Array) -> pa.Array:
        codec = _codec(sent, key)
        return pa.array([codec.decode(np.frombuffer(x.as_py() or b"", dtype="<u4")) for x in batch], pa.binary())

    return df.withColumn(out, arrow_column(kernel, "binary")(F.col(ids)))
