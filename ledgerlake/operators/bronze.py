"""Bronze layer: canonical names and lineage metadata (strict and ruled profiles)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import RAW_COLUMNS, STRICT_RENAMES
from ledgerlake.functions import record_hash
from ledgerlake.sources.csv import FILE_COLUMNS, SCANNED_NAME, SCANNED_PATH

DEFAULT_SOURCE_FILE = "events.parquet"
DEFAULT_RUN_ID = "fixture_run"


def rename_columns(raw: DataFrame, renames: dict[str, str] = STRICT_RENAMES) -> DataFrame:
    """Rename by map in one projection; absent source columns are skipped."""
    present = {k: v for k, v in renames.items() if k in raw.columns}
    return raw.withColumnsRenamed(present)


def _value(v: Column | str) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def add_lineage(dataframe: DataFrame, source_file_name: Column | str, pipeline_run_id: str,
                ingested_at: Column | None = None) -> DataFrame:
    """Strict-profile lineage: source file, run id, ingestion time (now, if not given)."""
    return dataframe.withColumns(
        {
            "source_file_name": _value(source_file_name),
            "pipeline_run_id": F.lit(pipeline_run_id),
            "bronze_ingestion_timestamp": F.current_timestamp() if ingested_at is None else ingested_at,
        }
    )


def bronze_transactions(
    raw: DataFrame,
    pipeline_run_id: str = DEFAULT_RUN_ID,
    source_file_name: Column | str = DEFAULT_SOURCE_FILE,
) -> DataFrame:
    """Strict Bronze: raw -> renamed -> lineage (14 columns).

    Rows that a file scan labelled (``csv.FILE_COLUMNS``) name the file they came from.
    """
    if SCANNED_NAME in raw.columns:
        labelled = add_lineage(rename_columns(raw), F.col(SCANNED_NAME), pipeline_run_id)
        return labelled.drop(*[c for c in FILE_COLUMNS if c in raw.columns])
    return add_lineage(rename_columns(raw), source_file_name, pipeline_run_id)


def bronze_ruled(
    raw: DataFrame,
    pipeline_run_id: str = DEFAULT_RUN_ID,
    source_file_name: Column | str = DEFAULT_SOURCE_FILE,
    source_file_path: Column | str | None = None,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Ruled Bronze: raw names kept, extended lineage and a deterministic record hash.

    Rows that a file scan labelled name their own file and path.
    """
    now = F.current_timestamp() if ingested_at is None else ingested_at
    scanned = SCANNED_NAME in raw.columns
    name = F.col(SCANNED_NAME) if scanned else _value(source_file_name)
    path = F.col(SCANNED_PATH) if scanned else _value(source_file_name if source_file_path is None else source_file_path)
    return raw.withColumns(
        {
            "_pipeline_run_id": F.lit(pipeline_run_id),
            "_ingestion_timestamp": now,
            "_ingestion_date": F.to_date(now),
            "_source_file": name,
            "_source_file_path": path,
            "_record_hash": record_hash(RAW_COLUMNS),
        }
    ).drop(*(FILE_COLUMNS if scanned else []))


def to_raw_names(bronze: DataFrame) -> DataFrame:
    """Strict Bronze back to the 11 raw column names (a projection, no data movement)."""
    inverse = {v: k for k, v in STRICT_RENAMES.items()}
    return bronze.select(*[F.col(c).alias(inverse.get(c, c)) for c in
                           ["step", "transaction_type", "amount", "origin_account", "origin_old_balance",
                            "origin_new_balance", "destination_account", "destination_old_balance",
                            "destination_new_balance", "is_fraud", "is_flagged_fraud"]])
