"""Distinct counts from sketches that are kept beside a written table.

A HyperLogLog sketch of each wanted column is made for every data file (and
group), once, in the pass after the write.  Reading a distinct count then
merges a few kilobytes for each file instead of scanning the table, and the
sketches of several tables, or of files added later, merge as well.

With 2^k registers the estimate's relative standard error is about
1.04 / sqrt(2^k): 0.8 % at the default k = 14.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_REGISTERS = 14


def relative_error(log_registers: int = LOG_REGISTERS) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / 2 ** (log_registers / 2)


def file_sketches(table: DataFrame, columns: list[str], groups: list[str] | None = None,
                  log_registers: int = LOG_REGISTERS) -> DataFrame:
    """Rows ``groups, file, column_name, sketch`` of a table that reads files, one scan.

    NULL values aren't counted; a column without any value has an empty sketch."""
    groups = groups or []
    values = {c: F.col(c) if dict(table.dtypes)[c] in ("string", "bigint", "int", "binary") else F.col(c).cast("string")
              for c in columns}
    wide = table.groupBy(*groups, F.col("_metadata.file_name").alias("file")).agg(
        *[F.hll_sketch_agg(v, log_registers).alias(c) for c, v in values.items()])
    return wide.unpivot([*groups, "file"], columns, "column_name", "sketch")


def distinct_from_sketches(sketches: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Rows ``groups, column_name, distinct_values``: all files' sketches merged."""
    return sketches.groupBy(*(groups or []), "column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("bigint").alias("distinct_values"))
