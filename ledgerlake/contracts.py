"""Schemas, column contracts and metadata-only checks (no Spark job runs here)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values that must equal the reference's for identical results.
# Transaction-type domain, outgoing types, thresholds and ranges.
VALID_TRANSACTION_TYPES = ["CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER"]
OUTGOING_TYPES = ["PAYMENT", "TRANSFER", "CASH_OUT", "DEBIT"]
EXPECTED_FRAUD_TYPES = ["TRANSFER", "CASH_OUT"]
HIGH_VALUE_THRESHOLD = 200_000.0
BALANCE_TOLERANCE = 0.01
MIN_STEP = 1
MAX_STEP = 744
DEFAULT_RSD = 0.05
ORIGIN_ACCOUNT_PATTERN = r"^C[0-9]+$"
DESTINATION_ACCOUNT_PATTERN = r"^[CM][0-9]+$"
HASH_SEPARATOR = "||"
HASH_NULL_TOKEN = "<NULL>"

# Fixed values, too: the column names, types, orders and renames below are the data's contract.
RAW_COLUMNS = [
    "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
    "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud",
]

RAW_TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("step", T.IntegerType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("nameOrig", T.StringType(), False),
        T.StructField("oldbalanceOrg", T.DoubleType(), False),
        T.StructField("newbalanceOrig", T.DoubleType(), False),
        T.StructField("nameDest", T.StringType(), False),
        T.StructField("oldbalanceDest", T.DoubleType(), False),
        T.StructField("newbalanceDest", T.DoubleType(), False),
        T.StructField("isFraud", T.IntegerType(), False),
        T.StructField("isFlaggedFraud", T.IntegerType(), False),
    ]
)

# Raw -> canonical names of the strict ("M") profile.
STRICT_RENAMES = {
    "type": "transaction_type",
    "nameOrig": "origin_account",
    "oldbalanceOrg": "origin_old_balance",
    "newbalanceOrig": "origin_new_balance",
    "nameDest": "destination_account",
    "oldbalanceDest": "destination_old_balance",
    "newbalanceDest": "destination_new_balance",
    "isFraud": "is_fraud",
    "isFlaggedFraud": "is_flagged_fraud",
}

# Raw -> canonical names of the ruled ("N") profile.
RULED_RENAMES = {
    "type": "transaction_type",
    "nameOrig": "origin_account",
    "oldbalanceOrg": "old_balance_origin",
    "newbalanceOrig": "new_balance_origin",
    "nameDest": "destination_account",
    "oldbalanceDest": "old_balance_destination",
    "newbalanceDest": "new_balance_destination",
    "isFraud": "is_fraud",
    "isFlaggedFraud": "is_flagged_fraud",
}

BRONZE_REQUIRED_COLUMNS = [
    "step", "transaction_type", "amount", "origin_account", "origin_old_balance",
    "origin_new_balance", "destination_account", "destination_old_balance",
    "destination_new_balance", "is_fraud", "is_flagged_fraud",
]

SILVER_REQUIRED_COLUMNS = BRONZE_REQUIRED_COLUMNS + [
    "transaction_day", "transaction_hour", "is_high_value_transaction",
    "origin_balance_error", "destination_balance_error",
]

# Columns a leakage-free feature table must never expose.
PROHIBITED_FEATURE_COLUMNS = {
    "old_balance_origin", "new_balance_origin",
    "old_balance_destination", "new_balance_destination",
}

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_run_id", T.StringType(), False),
        T.StructField("pipeline_stage", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("row_count", T.LongType(), False),
        T.StructField("column_count", T.IntegerType(), False),
        T.StructField("reconciliation_status", T.StringType(), False),
        T.StructField("execution_time_seconds", T.DoubleType(), False),
        T.StructField("audit_timestamp_utc", T.TimestampType(), False),
    ]
)


def find_missing_columns(dataframe: DataFrame, required_columns: Sequence[str]) -> list[str]:
    """Required columns absent from ``dataframe``, in the order required."""
    present = set(dataframe.columns)
    return [c for c in required_columns if c not in present]


def validate_required_columns(
    dataframe: DataFrame, required_columns: Sequence[str], dataframe_name: str
) -> None:
    """Raise ``ValueError`` naming the missing columns; analysis only, no job."""
    missing = find_missing_columns(dataframe, required_columns)
    if missing:
        raise ValueError(f"{dataframe_name} is missing required columns: {missing}")


def schema_drift(actual_columns: Sequence[str], expected_columns: Sequence[str]) -> dict:
    """Missing / unexpected columns (sorted) and whether the order matches."""
    actual, expected = list(actual_columns), list(expected_columns)
    return {
        "missing_columns": sorted(set(expected) - set(actual)),
        "unexpected_columns": sorted(set(actual) - set(expected)),
        "column_order_matches": actual == expected,
    }


def assert_no_balance_leakage(dataframe: DataFrame) -> None:
    """Feature tables must not carry balance columns (target leakage)."""
    leaked = set(dataframe.columns) & PROHIBITED_FEATURE_COLUMNS
    if leaked:
        raise ValueError(f"Balance fields must not be in the feature table: {sorted(leaked)}")


def schema_profile(dataframe: DataFrame) -> list[tuple[str, str, bool]]:
    """(column, Spark type, nullable) for every column: metadata only, no job."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in dataframe.schema.fields]
