"""Incremental Bronze -> Silver ingestion with Structured Streaming.

The batch operators are reused unchanged on a streaming DataFrame: new raw
files landing in a folder are parsed with the explicit schema, get lineage
(the file name comes from the ``_metadata`` column of the file source), pass
the strict validity filter and are appended (a line that does not parse fails
the query, as it fails a batch scan) to the day-partitioned Silver
table. Progress lives in the checkpoint folder, so a restarted or failed query
resumes where it stopped without duplicating rows (the file sink is
exactly-once). ``availableNow`` processes everything present and stops, which
is how a scheduled run uses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.contracts import HIGH_VALUE_THRESHOLD, RAW_TRANSACTION_SCHEMA
from ledgerlake.operators import bronze as B
from ledgerlake.operators import silver as S


def read_raw_stream(spark: SparkSession, source_dir: str, schema: T.StructType = RAW_TRANSACTION_SCHEMA,
                    fmt: str = "csv", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def bronze_stream(raw: DataFrame, pipeline_run_id: str) -> DataFrame:
    """Strict Bronze on a stream; the source file name is taken per row from file metadata."""
    renamed = B.rename_columns(raw)
    return renamed.withColumns(
        {
            "source_file_name": F.col("_metadata.file_name"),
            "pipeline_run_id": F.lit(pipeline_run_id),
            "bronze_ingestion_timestamp": F.current_timestamp(),
        }
    )


def start_silver_ingest(spark: SparkSession, source_dir: str, silver_dir: str, checkpoint_dir: str,
                        pipeline_run_id: str, high_value_threshold: float = HIGH_VALUE_THRESHOLD,
                        fmt: str = "csv", available_now: bool = True) -> StreamingQuery:
    """Start the incremental ingest; returns the running query."""
    silver = S.silver_transactions(bronze_stream(read_raw_stream(spark, source_dir, fmt=fmt), pipeline_run_id),
                                   high_value_threshold)
    writer = (
        silver.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_dir)
        .partitionBy("transaction_day")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(silver_dir)
