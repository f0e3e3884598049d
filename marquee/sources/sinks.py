"""Materialisation and result sinks (S5-S10)."""

from __future__ import annotations

import functools
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Names the current version of a table, inside its folder.
POINTER = "current.txt"
#: Names the parts of an ordered result in their order, one to a line.
PART_ORDER = "order.txt"
#: How result files are written and read: headed, values as they are.
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def as_view(df: DataFrame, name: str) -> DataFrame:
    """S5: a lazily re-evaluated model (the reference's VIEW)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(df: DataFrame, path: str, partition_cols=None, sort_within=None) -> DataFrame:
    """S6: create-or-replace a Parquet table and return a reader of it.

    Every write makes a new version folder; a pointer file is switched to it
    by one rename once the write is whole.  So a table can be replaced while
    it is read, or from itself, and a failed write leaves the old one.
    ``drop_old_versions`` removes what no reader needs any more.

    Writing cuts the lineage: later models read files, so a lost executor
    does not re-run the upstream plan.  ``sort_within`` clusters rows inside
    each file (better min/max pruning for later key filters).
    """
    return as_counted_table(df, path, partition_cols, sort_within)[0]


def as_counted_table(df: DataFrame, path: str, partition_cols=None,
                     sort_within=None) -> tuple[DataFrame, int]:
    """``as_table`` that also returns the number of rows written, observed
    during the write itself (no second job to count the table)."""
    obs = Observation()
    w = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if sort_within:
        w = w.sortWithinPartitions(*sort_within)
    writer = w.write
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    # Names in order of time: a version's age shows in its name.
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    writer.parquet(f"{path}/{version}")
    _point(df.sparkSession, path, version)
    return df.sparkSession.read.parquet(f"{path}/{version}"), int(obs.get["rows"])


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _point(spark: SparkSession, path: str, version: str, pointer: str = POINTER, lines: list[str] | None = None) -> None:
    """Switch the table's pointer to a version (or to ``lines`` about it), by one atomic rename."""
    fs = spark._jvm.org.apache.hadoop.fs
    made, system = _file_system(spark, f"{path}/.{version}.txt")
    out = system.create(made, True)
    out.write(bytearray("\n".join([version] if lines is None else lines).encode()))
    out.close()
    over = spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    over[0] = getattr(fs, "Options$Rename").OVERWRITE
    files = fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    files.rename(system.makeQualified(made), system.makeQualified(fs.Path(f"{path}/{pointer}")), over)


def current_version(spark: SparkSession, path: str) -> str:
    """The folder of the table's current version."""
    return f"{path}/" + spark.read.text(f"{path}/{POINTER}").first()["value"]


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that ``as_table`` wrote, from this or another session."""
    return spark.read.parquet(current_version(spark, path))


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the newest ``keep`` versions (the current one always stays); their names.

    Versions newer than the current one are writes that aren't done, or failed, and stay as well."""
    if keep < 1:
        raise ValueError("the current version can't be dropped")
    current = current_version(spark, path).rsplit("/", 1)[1]
    where, system = _file_system(spark, path)
    done = sorted(name for f in system.listStatus(where) if f.isDirectory()
                  and (name := f.getPath().getName()).startswith("v") and name <= current)
    for name in done[:-keep]:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    return done[:-keep]


def write_result_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """S8: one headed CSV (folder of headed parts) per analysis, values as
    they are (the writer's own trimming of outer white space is turned off).
    ``single_file=True`` forces one part through ``coalesce(1)``; use it
    only for results known to be small."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**_CSV).csv(path)
    return path


def write_ordered_csv(df: DataFrame, path: str, order_by, parts: int = 16) -> str:
    """S8 for results whose row order is to be kept: range-dealt, sorted parts and a list of them in order.

    ``order_by`` names columns or sort expressions; rows of equal keys are
    dealt by a hash of their values (any order among them is right), so a hot
    key is spread over parts.  ``parts`` is the number of files, and of scans
    in a later reading plan: at most a few hundred.  A new write replaces the
    list at its end, by one rename.
    """
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    keys = [*[F.col(k) if isinstance(k, str) else k for k in order_by], F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    (df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
       .write.options(**_CSV).csv(f"{path}/{version}"))
    where, system = _file_system(df.sparkSession, f"{path}/{version}")
    # A part's name begins with its task's number, which is its range's.
    names = sorted((name for f in system.listStatus(where) if (name := f.getPath().getName()).startswith("part-")),
                   key=lambda name: int(name.split("-")[1]))
    _point(df.sparkSession, path, version, PART_ORDER, [f"{version}/{name}" for name in names])
    return path


def read_ordered_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """S10 without a sort: the parts of ``write_ordered_csv`` one behind the other.

    Each part is its own scan, and a union keeps the order of its inputs'
    partitions, so the rows come back in order with no shuffle."""
    listed = spark.read.text(f"{path}/{PART_ORDER}", wholetext=True).first()
    parts = [spark.read.schema(schema).options(**_CSV).csv(f"{path}/{name}")
             for name in (listed["value"].split("\n") if listed and listed["value"] else [])]
    return functools.reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)


def preview(df: DataFrame, n: int = 25) -> tuple[list, int]:
    """S9: the first n rows (in the result's own order) and how many rows
    were left out.  Only n rows and one count reach the driver."""
    head = df.limit(n).collect()
    rest = df.count() - len(head) if len(head) == n else 0
    return head, rest


def read_result_csv(spark: SparkSession, path: str, schema, order_by=()) -> DataFrame:
    """S10: read a written result back with a known schema (no inference).

    A folder of parts has no row order of its own: ``order_by`` names the
    result's sort keys (columns or names; see ``analyses.ORDER``)."""
    df = spark.read.schema(schema).options(**_CSV).csv(path)
    return df.orderBy(*order_by) if order_by else df
