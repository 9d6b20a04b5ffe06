"""Strict Silver: one validity filter plus time, balance and indicator features.

Everything is a single Filter + Project over Bronze, so Catalyst fuses it into
one codegen stage and pushes the filter into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import (
    BRONZE_REQUIRED_COLUMNS,
    HIGH_VALUE_THRESHOLD,
    VALID_TRANSACTION_TYPES,
    validate_required_columns,
)
from ledgerlake.functions import day_from_step, flag, hour_from_step


def validity_predicate() -> Column:
    """Strict rule: a NULL in any tested field drops the row."""
    c = F.col
    return (
        c("step").isNotNull()
        & (c("step") > 0)
        & c("transaction_type").isin(*VALID_TRANSACTION_TYPES)
        & c("amount").isNotNull()
        & (c("amount") >= 0)
        & c("origin_account").isNotNull()
        & c("destination_account").isNotNull()
        & c("is_fraud").isin(0, 1)
        & c("is_flagged_fraud").isin(0, 1)
    )


def select_valid(bronze: DataFrame) -> DataFrame:
    validate_required_columns(bronze, BRONZE_REQUIRED_COLUMNS, "bronze_dataframe")
    return bronze.filter(validity_predicate())


def time_features(dataframe: DataFrame) -> DataFrame:
    return dataframe.withColumns(
        {"transaction_day": day_from_step("step"), "transaction_hour": hour_from_step("step")}
    )


def balance_features(dataframe: DataFrame) -> DataFrame:
    c = F.col
    return dataframe.withColumns(
        {
            "origin_balance_change": F.round(c("origin_old_balance") - c("origin_new_balance"), 2),
            "destination_balance_change": F.round(
                c("destination_new_balance") - c("destination_old_balance"), 2
            ),
            "origin_balance_error": F.round(
                c("origin_old_balance") - c("amount") - c("origin_new_balance"), 2
            ),
            "destination_balance_error": F.round(
                c("destination_old_balance") + c("amount") - c("destination_new_balance"), 2
            ),
        }
    )


def transaction_indicators(dataframe: DataFrame, high_value_threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    c = F.col
    return dataframe.withColumns(
        {
            "is_high_value_transaction": flag(c("amount") >= F.lit(high_value_threshold)),
            "is_zero_amount_transaction": flag(c("amount") == 0),
            "is_origin_merchant": flag(c("origin_account").startswith("M")),
            "is_destination_merchant": flag(c("destination_account").startswith("M")),
        }
    )


def silver_features(valid: DataFrame, high_value_threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Time, balances and indicators of rows that passed the filter (24 columns)."""
    return (
        valid
        .transform(time_features)
        .transform(balance_features)
        .transform(transaction_indicators, high_value_threshold)
    )


def silver_transactions(bronze: DataFrame, high_value_threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Strict Silver (24 columns): filter -> time -> balances -> indicators."""
    return silver_features(select_valid(bronze), high_value_threshold)


def without_timestamps(dataframe: DataFrame) -> DataFrame:
    """Drop wall-clock lineage columns (for deterministic comparisons)."""
    drop = [c for c in dataframe.columns if c in ("bronze_ingestion_timestamp", "_ingestion_timestamp", "_ingestion_date")]
    return dataframe.drop(*drop)
