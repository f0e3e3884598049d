"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import time
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import workspace_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = workspace_dir(spark) + "/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Drop the shuffle files of finished steps.

    Spark's context cleaner removes a shuffle once its plan is unreachable on
    the driver; a long job would otherwise hold all of them until the driver
    happens to collect its garbage.  The end of a query is told to listeners
    in the background, which keep its plan for a moment: hence the second try.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def arrow_column(kernel: Callable[[pa.Array], pa.Array], kind: str):
    """A column function from an Arrow kernel; only its argument travels to Python."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield kernel(batch)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returnType=kind)


def texts(batch: pa.Array) -> list[str]:
    """The batch's strings, nulls as empty."""
    return ["" if t is None else t for t in batch.to_pylist()]


def utf8_views(batch: pa.Array) -> list[bytes]:
    """The batch's strings as UTF-8 bytes, nulls as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(batch.type) else pa.binary()
    return [b"" if t is None else t for t in batch.cast(kind).to_pylist()]


def binary_array(parts: list[np.ndarray], sizes: np.ndarray) -> pa.Array:
    """A binary array over the joined parts, without a copy for each value; ``sizes`` in bytes."""
    offsets = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=offsets[1:])
    data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(
        pa.binary())


def row_count_bytes(df: DataFrame, column: str) -> tuple[int, int]:
    """Rows and bytes of one text column, from one aggregate."""
    got = df.agg(F.count(F.lit(1)).alias("n"),
                 F.coalesce(F.sum(F.octet_length(F.col(column))), F.lit(0)).alias("b")).first()
    return int(got["n"]), int(got["b"])


#: Up to so many rows of ids are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def broadcast_if_few(df: DataFrame) -> DataFrame:
    """``df`` (a written table of narrow rows) marked for broadcast where its counted rows allow it."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


_made: dict[str, tuple] = {}


def made_once(kind: str, sent, make: Callable, key=None):
    """``make(sent.value)`` for a broadcast, made once in each Python worker; only the last one is kept.

    A function of a module is sent by its name, so all tasks of a worker share
    this module's dictionary; a nested function would carry a copy of its own.
    A worker holds one object for a broadcast as long as Spark knows it; with a
    ``key`` broadcasts of the same key share what was made."""
    key, held = sent if key is None else key, _made.get(kind)
    if held is None or held[0] != key:
        _made.clear()
        held = _made[kind] = (key, make(sent.value))
    return held[1]


def drop_made() -> None:
    """Give back what earlier steps made in this Python worker: Spark uses its workers again for later ones."""
    if _made:
        _made.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


#: Characters of text that a kernel handles at once; bounds the memory of a task.
CHUNK = 2 << 20


def text_chunks(batch: pa.Array, size: int = CHUNK) -> Iterator[list[str]]:
    """The batch's strings (nulls as empty) in runs of about ``size`` bytes, a longer string alone."""
    return map(texts, array_chunks(batch, size))


def array_chunks(batch: pa.Array, size: int = CHUNK) -> Iterator[pa.Array]:
    """Slices of the batch of about ``size`` bytes."""
    lengths = pc.binary_length(batch).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(lengths) // size
    at = 0
    while at < len(batch):
        to = int(np.searchsorted(group, group[at], side="right"))
        yield batch.slice(at, to - at)
        at = to


class PieceTable:
    """Token ids of the distinct pieces that a worker has met, solved once each; emptied beyond ``limit``."""

    def __init__(self, solve: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int):
        self.solve, self.limit = solve, limit
        self.clear()

    def clear(self) -> None:
        self.number = _numbering()
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.first, self.width = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def make_room(self) -> None:
        if len(self.number) > self.limit:
            self.clear()

    def ids(self, rows: list[Iterable[str]], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows' pieces in order, and each row's number of ids; ``sizes``: pieces of each row."""
        return self._gather(self._codes(chain.from_iterable(rows), int(sizes.sum())), sizes)

    def ids_of_lists(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """The same for a list array of pieces; only the distinct ones become Python strings."""
        coded = lists.flatten().dictionary_encode()
        codes = self._codes(coded.dictionary.to_pylist(), len(coded.dictionary))
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        return self._gather(codes[coded.indices.to_numpy(zero_copy_only=False)], sizes)

    def _codes(self, pieces: Iterable[str], count: int) -> np.ndarray:
        known = len(self.number)
        codes = np.fromiter(map(self.number.__getitem__, pieces), dtype=np.int64, count=count)
        new = list(islice(self.number, known, None))
        if new:
            flat, width = self.solve(new)
            self.flat = _fitted(self.flat, self.used, flat)
            self.width = _fitted(self.width, known, width)
            self.first = _fitted(self.first, known, self.used + np.cumsum(width) - width)
            self.used += len(flat)
        return codes

    def _gather(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wide = self.width[codes]
        ends = np.concatenate(([0], np.cumsum(wide)))
        at = np.repeat(self.first[codes] - ends[:-1], wide) + np.arange(ends[-1])
        return self.flat[at], np.diff(ends[np.concatenate(([0], np.cumsum(sizes)))])


def _numbering() -> defaultdict[str, int]:
    """A dictionary that numbers its keys as they come."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    return number


def _fitted(held: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
    """``held`` with ``new`` behind its first ``used`` values, grown by doubling."""
    if used + len(new) > len(held):
        held = np.concatenate((held[:used], np.zeros(max(used, 2 * len(new)), held.dtype)))
    held[used:used + len(new)] = new
    return held
