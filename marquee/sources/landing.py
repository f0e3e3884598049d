"""Landing a text-only source untouched (S1-S4) and checking it."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marquee.operators.profile import null_profile
from marquee.session import path_exists
from marquee.sources.sinks import current_version
from marquee.sources.synthetic import RAW_COLUMNS


log = logging.getLogger(__name__)


def all_string_schema(columns=RAW_COLUMNS) -> StructType:
    """Explicit all-text schema: types are decided in staging, never inferred."""
    return StructType([StructField(c, StringType(), True) for c in columns])


class ContractError(ValueError):
    pass


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the file header (reads only the first line)."""
    return spark.read.option("header", True).csv(path).columns


def check_contract(columns: list[str], expected=RAW_COLUMNS) -> dict:
    """S2: missing columns are an error, extra columns only a note."""
    missing = sorted(set(expected) - set(columns))
    extra = sorted(set(columns) - set(expected))
    if missing:
        raise ContractError(f"source is missing expected columns: {missing}")
    return {"missing": missing, "extra": extra}


def contract_frame(spark: SparkSession, columns: list[str], expected=RAW_COLUMNS) -> DataFrame:
    """S2 as rows: (column_name, status) with status expected/missing/extra."""
    rows = [(c, "expected" if c in columns else "missing") for c in expected]
    rows += [(c, "extra") for c in columns if c not in expected]
    return spark.createDataFrame(rows, "column_name string, status string")


# Holds the whole record of a row that has more fields than the header names.
SURPLUS = "surplus_fields"


def read_csv_landing(spark: SparkSession, path: str, expected=RAW_COLUMNS,
                     check: bool = True, multi_line: bool = True,
                     partitions: int | None = None, surplus: bool = True) -> DataFrame:
    """S1: headed UTF-8 CSV, every column text, nothing trimmed or parsed.

    Short rows are padded with NULL (PERMISSIVE mode), an empty field lands
    as NULL, quoted fields may contain commas, doubled quotes and newlines.
    Extra columns beyond the contract are kept as text and named in the log.
    A row with more fields than the header lands with its first fields in
    place and its whole record in ``surplus_fields`` (NULL elsewhere), so no
    value is lost; ``surplus=False`` leaves that column out.  Every file's own
    header is checked: a file whose columns differ in name or order from the
    first one's fails the read instead of landing values under wrong names.

    Quoted newlines need ``multi_line=True``, which reads each file in one
    task (a file cannot be split without knowing the quote state).  For
    sources known to have no embedded newlines pass ``multi_line=False``:
    files are then split by ``spark.sql.files.maxPartitionBytes``.  When a
    few files hold most rows, ``partitions`` rebalances the rows right after
    the read (round-robin), so every later stage and the written landing are
    even, whatever the file sizes.
    """
    require_inputs(spark, path)
    header = read_header(spark, path)
    if check:
        extra = check_contract(header, expected)["extra"]
        if extra:
            log.info("source %s has extra columns: %s", path, ", ".join(extra))
    # The header's own names, all strings, and room for malformed records.
    schema = all_string_schema([*header, SURPLUS])
    df = (spark.read.schema(schema)
               .option("header", True)
               .option("multiLine", multi_line)
               .option("escape", '"')
               .option("encoding", "UTF-8")
               .option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", SURPLUS)
               .option("ignoreLeadingWhiteSpace", False)
               .option("ignoreTrailingWhiteSpace", False)
               .option("enforceSchema", False)
               .csv(path))
    if surplus:
        # The reader reports short rows as malformed too; only those with a
        # field behind the last column of the header are over-long.
        behind = F.from_csv(SURPLUS, ", ".join(f"c{i} string" for i in range(len(header) + 1)),
                            {"escape": '"', "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "false",
                             "ignoreTrailingWhiteSpace": "false"})[f"c{len(header)}"]
        df = df.withColumn(SURPLUS, F.when(behind.isNotNull(), F.col(SURPLUS)))
    else:
        df = df.drop(SURPLUS)
    return df.repartition(partitions) if partitions else df


def require_inputs(spark: SparkSession, *paths: str) -> None:
    """L4: fail early when an input (landing, warehouse) is missing, in any file system."""
    for p in paths:
        if not path_exists(spark, p):
            raise FileNotFoundError(f"missing input: {p}")


def write_csv_landing(df: DataFrame, path: str, compression: str | None = None) -> str:
    """Write a landing as headed CSV (quotes escaped by doubling).  Files may be
    compressed, for instance by ``gzip``; the readers open them as they are."""
    # The writer trims outer spaces by default; a landing must stay untouched.
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path, compression=compression))
    return path


def landing_profile(df: DataFrame, columns=RAW_COLUMNS) -> DataFrame:
    """S3: NULL count per landed column (one scan), only columns with NULLs."""
    return null_profile(df, [c for c in columns if c in df.columns])


def landing_size(df: DataFrame) -> DataFrame:
    """S4: (rows, columns) of the landing; the row count is one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"))


def _footer_counts(spark: SparkSession, path: str) -> tuple[int, dict[str, int]]:
    """Rows, and values that are not null by column, of a written table, from its files' footers.

    Spark's newer Parquet reader answers counts without reading any page
    (``PushedAggregation``); it is asked for in a session of its own, so the
    caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = own.read.parquet(current_version(spark, path))
    counts = [F.count(F.col(f"`{c}`")).alias(f"c{k}") for k, c in enumerate(df.columns)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *counts).first()
    # Pushed counts of no files are NULL.
    return row["rows"] or 0, {c: row[f"c{k}"] or 0 for k, c in enumerate(df.columns)}


def stored_profile(spark: SparkSession, path: str, keep_zero: bool = False) -> DataFrame:
    """S3 of a written landing from its files' metadata: no column is read."""
    rows, present = _footer_counts(spark, path)
    nulls = [(c, rows - n) for c, n in present.items() if keep_zero or rows > n]
    return spark.createDataFrame(nulls, "column_name string, null_rows bigint")


def stored_size(spark: SparkSession, path: str) -> DataFrame:
    """S4 of a written landing from its files' metadata."""
    rows, present = _footer_counts(spark, path)
    return spark.createDataFrame([(rows, len(present))], "rows bigint, columns bigint")
