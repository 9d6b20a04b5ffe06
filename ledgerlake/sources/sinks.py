"""Sinks: Parquet tables, named CSV exports, append-only run records.

Nothing passes through the driver: even "small" exports are written by Spark
(``coalesce(1)`` only for tables known to be small, e.g. marts keyed by day).
A write can count what it writes: measures are observed on the rows of its own
last stage, so no table has to be read again to be reconciled or audited.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows of a file, where files per partition value are planned.
ROWS_PER_FILE = 4_000_000
#: Times as many files as planned that a write without a shuffle may leave.
EXTRA_FILES = 4


@dataclass(frozen=True)
class Written:
    """What a write left behind, counted while it was written."""

    path: str
    columns: int
    rows: int
    seconds: float
    values: dict[str, Any] = field(default_factory=dict)


def files_per_value(df: DataFrame, column: Column, rows_per_file: int = ROWS_PER_FILE) -> dict[Any, int] | None:
    """Files that each partition value needs, or None where a write without a shuffle does about as well.

    One narrow pass counts the rows of each value, and how many tasks hold it: written as it
    stands, each of them leaves a file. Time-ordered sources hold few days a task and need no shuffle.
    """
    cells = df.groupBy(F.spark_partition_id().alias("task"), column.alias("value")).agg(F.count("*").alias("n"))
    found = cells.groupBy("value").agg(F.count("*").alias("tasks"), F.sum("n").alias("rows")).collect()  # a row per value
    files = {r["value"]: -(-r["rows"] // rows_per_file) for r in found}
    return None if sum(r["tasks"] for r in found) <= EXTRA_FILES * sum(files.values()) else files


def spread(df: DataFrame, column: str, files: Mapping[Any, int]) -> DataFrame:
    """Rows dealt by (value, salt): one task a value, or as many as a hot value has files."""
    hot = {v: n for v, n in files.items() if n > 1 and v is not None}
    salt = F.lit(0)
    if hot:
        of_value = F.create_map(*[x for v, n in hot.items() for x in (F.lit(v), F.lit(n))])[F.col(column)]
        salt = F.coalesce(F.pmod(F.monotonically_increasing_id(), of_value), F.lit(0))
    return df.withColumn("_salt", salt).repartition(column, "_salt").drop("_salt")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_columns: Sequence[str] | None = None,
                  files: Mapping[Any, int] | None = None, measures: Mapping[str, Column] | None = None) -> Written:
    """Parquet, optionally partitioned; ``measures`` are aggregates over the written rows.

    Partitioned writes don't shuffle: each task writes the values that it holds. With ``files``
    (of :func:`files_per_value`, for one partition column) rows are dealt by value and salt first.
    Measures are observed behind that shuffle, so a stage that runs again is not counted twice.
    """
    began = time.perf_counter()
    if files is not None and partition_columns:
        df = spread(df, partition_columns[0], files)
    observation = Observation()
    counted = df.observe(observation, F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in (measures or {}).items()])
    writer = counted.write.mode(mode)
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    writer.parquet(path)
    values = dict(observation.get)
    return Written(path, len(df.columns), int(values.pop("rows", 0) or 0), round(time.perf_counter() - began, 3), values)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False,
              sort_by: Sequence[str] | None = None, observation: Observation | None = None) -> None:
    """CSV with header; whitespace and empty strings are kept as they are. ``observation`` counts the rows."""
    if single_file:
        # A range-sorted frame coalesced to one partition keeps its global order.
        out = (df.orderBy(*sort_by) if sort_by else df).coalesce(1)
    else:
        out = df.sortWithinPartitions(*sort_by) if sort_by else df
    if observation is not None:  # behind the sort, whose sampling reads the rows once more
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    (
        out.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", '""')
        .csv(path)
    )


def export_small_table(df: DataFrame, path: str, sort_by: Sequence[str] | None = None) -> None:
    """A small mart as a folder with one CSV file (written by one task, not collected)."""
    write_csv(df, path, single_file=True, sort_by=sort_by)


def export_csv_file(df: DataFrame, folder: str, file_name: str, sort_by: Sequence[str] | None = None) -> Written:
    """A small table as the one file ``folder/file_name``, replacing an earlier one; its rows counted.

    Spark writes a part file into a folder of its own; when that job has committed, the file is
    moved to its name through the file system of ``folder``, which may be any that Hadoop
    knows. A failed job leaves the earlier file as it was.
    """
    spark = df.sparkSession
    began = time.perf_counter()
    observation = Observation()
    staging = f"{folder.rstrip('/')}/_staging-{uuid.uuid4().hex[:12]}"
    write_csv(df, staging, single_file=True, sort_by=sort_by, observation=observation)
    path = _move_part(spark, staging, folder, file_name)
    return Written(path, len(df.columns), int(observation.get.get("rows", 0)), round(time.perf_counter() - began, 3))


def _move_part(spark: SparkSession, staging: str, folder: str, file_name: str) -> str:
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(staging), hadoop.Path(folder, file_name)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise OSError(f"expected one part file in {staging}, found {len(parts)}")
    fs.delete(target, True)
    if not fs.rename(parts[0], target):
        raise OSError(f"could not move the export to {target.toString()}")
    fs.delete(source, True)
    return target.toString()


def append_records(df: DataFrame, path: str, partition_column: str = "pipeline_run_id") -> None:
    """Audit / summary / failure rows, partitioned by run id; writing a run id again replaces its rows."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_column).parquet(path)


def write_many(tables: Mapping[str, DataFrame], base_path: str, max_parallel: int = 4,
               measures: Mapping[str, Mapping[str, Column]] | None = None) -> dict[str, Written]:
    """Write independent tables as concurrent Spark jobs.

    Each table is its own job; submitting them from a small thread pool lets the
    scheduler overlap short jobs (and fill the cluster) instead of queueing them.
    """

    def one(name: str) -> Written:
        return write_parquet(tables[name], f"{base_path.rstrip('/')}/{name}", measures=(measures or {}).get(name))

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        return dict(zip(tables, pool.map(one, tables), strict=True))
