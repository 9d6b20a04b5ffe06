"""Leakage-free fraud features from each origin account's prior history.

History is ordered by (step, record hash): rows that tie on both are full
duplicates, so their outputs are interchangeable and the bag of result rows is
deterministic. The default path splits by key size: the window form
is used for ordinary keys; keys above a row threshold go through the scan
(``prior_history``), and tests check both against each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import BRONZE_REQUIRED_COLUMNS, VALID_TRANSACTION_TYPES, assert_no_balance_leakage
from ledgerlake.functions import record_hash
from ledgerlake.operators.history import prior_history, prior_history_scan, prior_history_window

STRICT_FEATURE_COLUMNS = [
    "step", "transaction_day", "transaction_hour", "transaction_type", "amount", "origin_account",
    "destination_account", "is_high_value_transaction", "is_destination_merchant",
    "prior_origin_transaction_count", "prior_origin_average_amount", "prior_origin_maximum_amount", "is_fraud",
]

RULED_FEATURE_COLUMNS = [
    "_record_hash", "step", "transaction_day", "hour_of_day", "transaction_type", "amount", "amount_category",
    "origin_account", "destination_account", "destination_category", "is_customer_destination",
    "is_merchant_destination", "is_high_value_transaction", "is_cash_in", "is_cash_out", "is_debit",
    "is_payment", "is_transfer", "prior_origin_transaction_count", "prior_origin_total_amount",
    "prior_origin_average_amount", "prior_origin_maximum_amount", "prior_origin_fraud_count",
    "previous_transaction_step", "previous_transaction_amount", "steps_since_previous_transaction",
    "is_flagged_fraud", "is_fraud", "_pipeline_run_id", "_ingestion_timestamp", "_source_file",
]


def _history(df: DataFrame, method: str, key_counts: DataFrame | None = None) -> DataFrame:
    order = ["step", "_record_hash"]
    if method == "auto":
        return prior_history(df, "origin_account", order, key_counts=key_counts)
    if method == "window":
        return prior_history_window(df, "origin_account", order)
    if method == "scan":
        return prior_history_scan(df, "origin_account", order)
    raise ValueError(f"unknown history method: {method}")


def fraud_feature(silver: DataFrame, method: str = "auto", origin_counts: DataFrame | None = None) -> DataFrame:
    """Strict feature table (13 columns); first row of an account has NULL history.

    ``origin_counts`` may pass an already written origin-account summary, whose
    row counts decide which accounts are hot without another pass over Silver.
    """
    needed = [c for c in STRICT_FEATURE_COLUMNS if not c.startswith("prior_")]
    # The hash's bytes sort as its hex digits do, and are half as many to shuffle and to sort.
    base = silver.select(*needed, F.unhex(record_hash(BRONZE_REQUIRED_COLUMNS)).alias("_record_hash"))
    key_counts = None
    if origin_counts is not None:
        key_counts = origin_counts.select("origin_account", F.col("origin_transaction_count").alias("_key_rows"))
    hist = _history(base, method, key_counts)
    out = hist.withColumns(
        {
            "prior_origin_transaction_count": F.col("_prior_count"),
            "prior_origin_average_amount": F.round(
                F.when(F.col("_prior_count") > 0, F.col("_prior_sum") / F.col("_prior_count")), 2
            ),
            "prior_origin_maximum_amount": F.round(F.col("_prior_max"), 2),
        }
    )
    return out.select(*STRICT_FEATURE_COLUMNS)


def fraud_feature_profile(silver_ruled: DataFrame, method: str = "auto",
                          origin_counts: DataFrame | None = None) -> DataFrame:
    """Ruled feature table (31 columns): defaults filled, one-hot type, no balances.

    ``origin_counts`` may pass a written origin-account profile (its
    ``transaction_count`` decides which accounts are hot).
    """
    base_cols = [c for c in RULED_FEATURE_COLUMNS if c in silver_ruled.columns]
    key_counts = None
    if origin_counts is not None:
        key_counts = origin_counts.select("origin_account", F.col("transaction_count").alias("_key_rows"))
    hist = _history(silver_ruled.select(*base_cols), method, key_counts)
    c = F.col
    one_hot = {f"is_{t.lower()}": (c("transaction_type") == t).cast("int") for t in VALID_TRANSACTION_TYPES}
    out = hist.withColumns(
        {
            "prior_origin_transaction_count": c("_prior_count"),
            "prior_origin_total_amount": F.round(F.coalesce(c("_prior_sum"), F.lit(0.0)), 2),
            "prior_origin_average_amount": F.round(
                F.coalesce(F.when(c("_prior_count") > 0, c("_prior_sum") / c("_prior_count")), F.lit(0.0)), 2
            ),
            "prior_origin_maximum_amount": F.round(F.coalesce(c("_prior_max"), F.lit(0.0)), 2),
            "prior_origin_fraud_count": F.coalesce(c("_prior_fraud"), F.lit(0).cast("bigint")),
            "previous_transaction_step": c("_prev_step"),
            "previous_transaction_amount": F.coalesce(c("_prev_amount"), F.lit(0.0)),
            "steps_since_previous_transaction": F.coalesce(c("step") - c("_prev_step"), F.lit(-1)),
            **one_hot,
        }
    )
    result = out.select(*RULED_FEATURE_COLUMNS)
    assert_no_balance_leakage(result)
    return result
