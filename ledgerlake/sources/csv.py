"""CSV sources for raw transaction files.

Strict scans use an explicit schema, ``FAILFAST`` and ``enforceSchema=false``
so renamed headers are rejected. Column pruning means a ``count()`` on a CSV
scan parses no field at all, so malformed rows surface only when a query reads
the bad column: ``validate_all_columns`` runs one aggregate over every column
to make the whole file parse once, up front.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.contracts import RAW_TRANSACTION_SCHEMA, schema_drift

CORRUPT_COLUMN = "_corrupt_record"
#: Columns that ``with_files`` adds: where each row was read.
SCANNED_NAME, SCANNED_PATH, SCANNED_TIME = "_scanned_file", "_scanned_path", "_scanned_modified"
FILE_COLUMNS = [SCANNED_NAME, SCANNED_PATH, SCANNED_TIME]


class UnusableSource(ValueError):
    """The input is missing, empty or has another header."""


def with_files(scan: DataFrame) -> DataFrame:
    """The scan's rows, each with its file's name, path and modification time (its scan's own metadata)."""
    return scan.select(
        "*", F.col("_metadata.file_name").alias(SCANNED_NAME), F.col("_metadata.file_path").alias(SCANNED_PATH),
        F.col("_metadata.file_modification_time").alias(SCANNED_TIME),
    )


def read_csv_strict(spark: SparkSession, path: str, schema: T.StructType = RAW_TRANSACTION_SCHEMA) -> DataFrame:
    """Header + explicit schema + FAILFAST; header names must match the schema."""
    return (
        spark.read.option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("sep", ",")
        .option("encoding", "UTF-8")
        .schema(schema)
        .csv(path)
    )


def read_csv_permissive(spark: SparkSession, path: str, schema: T.StructType = RAW_TRANSACTION_SCHEMA) -> DataFrame:
    """Bad cells become NULL; the unparsed line is kept in ``_corrupt_record``."""
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
    return (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("sep", ",")
        .option("encoding", "UTF-8")
        .schema(with_corrupt)
        .csv(path)
    )


def validate_all_columns(df: DataFrame) -> int:
    """Parse every column once (raises on FAILFAST errors); returns the row count."""
    row = df.agg(F.count("*").alias("n"), *[F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)]).first()
    return int(row["n"])


def source_is_readable(spark: SparkSession, path: str, fmt: str = "csv") -> bool:
    """Input guard: the source exists and holds at least one row (reads one row)."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    try:
        return not reader.format(fmt).load(path).limit(1).isEmpty()
    except AnalysisException:  # no such path, no file in it, or a file of another format
        return False


def guard_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_TRANSACTION_SCHEMA) -> None:
    """Raise :class:`UnusableSource` before any row is ingested, if the input can't be what is expected."""
    if not source_is_readable(spark, path):
        raise UnusableSource(f"no rows to read at {path}")
    header = spark.read.option("header", True).csv(path).columns
    drift = schema_drift(header, schema.fieldNames())
    if drift["missing_columns"] or drift["unexpected_columns"] or not drift["column_order_matches"]:
        raise UnusableSource(f"the header of {path} differs: {drift}")


def split_rejects(scan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, rows that didn't) of a permissive scan; rejects keep their line beside the cells that could be read."""
    broken = F.col(CORRUPT_COLUMN).isNotNull()
    return scan.filter(~broken).drop(CORRUPT_COLUMN), scan.filter(broken)
