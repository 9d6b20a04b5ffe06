"""Ruled Silver: declarative hard rules and warnings, reason codes, quarantine.

Rules are data: a list of ``Rule(code, column_name, flag)``. All flags, counts,
reason texts and the status are computed in one projection, and Silver and
Quarantine are two filters over that same projection. Every flag is null-safe,
so each Bronze row lands in exactly one of Silver or Quarantine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contracts import (
    BALANCE_TOLERANCE,
    DESTINATION_ACCOUNT_PATTERN,
    HIGH_VALUE_THRESHOLD,
    MAX_STEP,
    MIN_STEP,
    ORIGIN_ACCOUNT_PATTERN,
    OUTGOING_TYPES,
    RULED_RENAMES,
    VALID_TRANSACTION_TYPES,
)
from ledgerlake.functions import day_from_step_ceil, failing, hour_from_step_mod, strict_flag
from ledgerlake.operators.bronze import bronze_ruled, rename_columns


@dataclass(frozen=True)
class Rule:
    code: str
    column: str
    flag: Column


def normalize_strings(dataframe: DataFrame) -> DataFrame:
    """Trim/upper the type, trim account identifiers.

    Nearly all types are written as they should be; only the others go through Unicode case mapping.
    """
    written = F.trim("transaction_type")
    return dataframe.withColumns(
        {
            "transaction_type": F.when(written.isin(*VALID_TRANSACTION_TYPES), written).otherwise(F.upper(written)),
            "origin_account": F.trim("origin_account"),
            "destination_account": F.trim("destination_account"),
        }
    )


def destination_category() -> Column:
    d = F.col("destination_account")
    return (
        F.when(d.startswith("M"), F.lit("MERCHANT"))
        .when(d.startswith("C"), F.lit("CUSTOMER"))
        .otherwise(F.lit("UNKNOWN"))
    )


def amount_category() -> Column:
    a = F.col("amount")
    return (
        F.when(a == 0, F.lit("ZERO"))
        .when(a < 1_000, F.lit("LOW"))
        .when(a < 50_000, F.lit("MEDIUM"))
        .when(a <= 200_000, F.lit("HIGH"))
        .otherwise(F.lit("VERY_HIGH"))
    )


def enrich(dataframe: DataFrame, high_value_threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Day/hour, destination category, indicators, amount bucket."""
    c = F.col
    stage = dataframe.withColumns(
        {
            "transaction_day": day_from_step_ceil("step"),
            "hour_of_day": hour_from_step_mod("step"),
            "destination_category": destination_category(),
        }
    )
    return stage.withColumns(
        {
            "is_customer_destination": (c("destination_category") == "CUSTOMER").cast("int"),
            "is_merchant_destination": (c("destination_category") == "MERCHANT").cast("int"),
            "is_high_value_transaction": (c("amount") > F.lit(high_value_threshold)).cast("int"),
            "is_zero_amount": (c("amount") == 0).cast("int"),
            "is_self_transfer": (c("origin_account") == c("destination_account")).cast("int"),
            "amount_category": amount_category(),
            "destination_balance_available": F.when(c("destination_category") == "MERCHANT", F.lit(0)).otherwise(F.lit(1)),
        }
    )


def hard_rules() -> list[Rule]:
    c = F.col
    critical = ["step", "transaction_type", "amount", "origin_account", "destination_account", "is_fraud", "is_flagged_fraud"]
    any_null = F.lit(False)
    for name in critical:
        any_null = any_null | c(name).isNull()
    return [
        Rule("MISSING_CRITICAL_FIELD", "fail_missing_critical_field", any_null.cast("int")),
        Rule("INVALID_TRANSACTION_TYPE", "fail_invalid_transaction_type", failing(c("transaction_type").isin(*VALID_TRANSACTION_TYPES))),
        Rule("INVALID_STEP", "fail_invalid_step", failing(c("step").between(MIN_STEP, MAX_STEP))),
        Rule("NEGATIVE_AMOUNT", "fail_negative_amount", strict_flag(c("amount") < 0)),
        Rule("INVALID_FRAUD_FLAG", "fail_invalid_fraud_flag", failing(c("is_fraud").isin(0, 1))),
        Rule("INVALID_FLAGGED_FRAUD", "fail_invalid_flagged_fraud", failing(c("is_flagged_fraud").isin(0, 1))),
        Rule("INVALID_ORIGIN_ACCOUNT", "fail_invalid_origin_account", failing(c("origin_account").rlike(ORIGIN_ACCOUNT_PATTERN))),
        Rule("INVALID_DESTINATION_ACCOUNT", "fail_invalid_destination_account", failing(c("destination_account").rlike(DESTINATION_ACCOUNT_PATTERN))),
    ]


def warning_rules(high_value_threshold: float = HIGH_VALUE_THRESHOLD) -> list[Rule]:
    c = F.col
    hv = F.lit(high_value_threshold)
    outgoing_error = F.abs(c("old_balance_origin") - c("amount") - c("new_balance_origin"))
    cash_in_error = F.abs(c("old_balance_origin") + c("amount") - c("new_balance_origin"))
    return [
        Rule("ZERO_AMOUNT", "warn_zero_amount", strict_flag(c("amount") == 0)),
        Rule("SELF_TRANSFER", "warn_self_transfer", strict_flag(c("origin_account") == c("destination_account"))),
        Rule("ORIGIN_BALANCE_MISMATCH", "warn_origin_balance_mismatch",
             strict_flag(c("transaction_type").isin(*OUTGOING_TYPES) & (outgoing_error > F.lit(BALANCE_TOLERANCE)))),
        Rule("CASH_IN_BALANCE_MISMATCH", "warn_cash_in_balance_mismatch",
             strict_flag((c("transaction_type") == "CASH_IN") & (cash_in_error > F.lit(BALANCE_TOLERANCE)))),
        Rule("HIGH_VALUE_TRANSFER_NOT_FLAGGED", "warn_high_value_transfer_not_flagged",
             strict_flag((c("transaction_type") == "TRANSFER") & (c("amount") > hv) & (c("is_flagged_fraud") == 0))),
        Rule("FLAGGED_RULE_MISMATCH", "warn_flagged_transaction_rule_mismatch",
             strict_flag((c("is_flagged_fraud") == 1) & ((c("transaction_type") != "TRANSFER") | (c("amount") <= hv)))),
        Rule("MERCHANT_BALANCE_ANOMALY", "warn_merchant_balance_anomaly",
             strict_flag((c("destination_category") == "MERCHANT")
                         & ((c("old_balance_destination") != 0) | (c("new_balance_destination") != 0)))),
    ]


def _total(rules: list[Rule]) -> Column:
    total = F.lit(0)
    for r in rules:
        total = total + F.col(r.column)
    return total.cast("int")


def _reasons(rules: list[Rule]) -> Column:
    return F.array_compact(F.array(*[F.when(F.col(r.column) == 1, F.lit(r.code)) for r in rules]))


def apply_rules(enriched: DataFrame, high_value_threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Rule flags, counts, reason arrays/texts and the validation status."""
    hard, warn = hard_rules(), warning_rules(high_value_threshold)
    flagged = enriched.withColumns({r.column: r.flag for r in hard + warn})
    counted = flagged.withColumns(
        {
            "hard_failure_count": _total(hard),
            "warning_count": _total(warn),
            "hard_failure_reasons": _reasons(hard),
            "warning_reasons": _reasons(warn),
        }
    )
    return counted.withColumns(
        {
            "hard_failure_reason_text": F.concat_ws("|", "hard_failure_reasons"),
            "warning_reason_text": F.concat_ws("|", "warning_reasons"),
            "validation_status": F.when(F.col("hard_failure_count") > 0, F.lit("QUARANTINE"))
            .when(F.col("warning_count") > 0, F.lit("VALID_WITH_WARNING"))
            .otherwise(F.lit("VALID")),
        }
    )


def validated_transactions(
    raw: DataFrame,
    pipeline_run_id: str = "fixture_run",
    source_file_name: str = "events.parquet",
    high_value_threshold: float = HIGH_VALUE_THRESHOLD,
) -> DataFrame:
    """Raw -> ruled Bronze -> renamed, normalized, enriched, rule-evaluated rows."""
    return validated_bronze(bronze_ruled(raw, pipeline_run_id, source_file_name), high_value_threshold)


def validated_bronze(bronze: DataFrame, high_value_threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """The rules over a ruled Bronze layer, whose lineage and record hash stay as they are."""
    return (
        rename_columns(bronze, RULED_RENAMES)
        .transform(normalize_strings)
        .transform(enrich, high_value_threshold)
        .transform(apply_rules, high_value_threshold)
    )


# Fixed output layouts of the ruled Silver and Quarantine tables.
SILVER_RULED_COLUMNS = [
    "_record_hash", "step", "transaction_day", "hour_of_day", "transaction_type", "amount",
    "amount_category", "origin_account", "destination_account", "destination_category",
    "is_customer_destination", "is_merchant_destination", "old_balance_origin", "new_balance_origin",
    "old_balance_destination", "new_balance_destination", "destination_balance_available",
    "is_high_value_transaction", "is_zero_amount", "is_self_transfer", "is_fraud", "is_flagged_fraud",
    "validation_status", "warning_count", "warning_reason_text", "_pipeline_run_id",
    "_ingestion_timestamp", "_ingestion_date", "_source_file", "_source_file_path",
]

QUARANTINE_COLUMNS = [
    "_record_hash", "step", "transaction_type", "amount", "origin_account", "destination_account",
    "is_fraud", "is_flagged_fraud", "validation_status", "hard_failure_count", "hard_failure_reason_text",
    "warning_count", "warning_reason_text", "_pipeline_run_id", "_ingestion_timestamp",
    "_ingestion_date", "_source_file", "_source_file_path",
]


def split_valid(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("hard_failure_count") == 0).select(*SILVER_RULED_COLUMNS)


def split_quarantine(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("hard_failure_count") > 0).select(*QUARANTINE_COLUMNS)


def rule_counts(validated: DataFrame, rules: list[Rule], rule_kind: str) -> DataFrame:
    """Long table (rule_kind, rule_code, rule_order, failed_records): one agg, then unpivot."""
    wide = validated.agg(*[F.sum(F.col(r.column)).cast("bigint").alias(r.code) for r in rules])
    stacked = wide.unpivot([], [r.code for r in rules], "rule_code", "failed_records")
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.code), F.lit(i + 1))])
    return stacked.select(
        F.lit(rule_kind).alias("rule_kind"),
        "rule_code",
        order[F.col("rule_code")].alias("rule_order"),
        F.coalesce("failed_records", F.lit(0).cast("bigint")).alias("failed_records"),
    )


def status_summary(validated: DataFrame) -> DataFrame:
    return validated.groupBy("validation_status").agg(
        F.count("*").alias("record_count"),
        F.sum("is_fraud").cast("bigint").alias("fraud_count"),
        F.round(F.sum("amount"), 2).alias("total_amount"),
    )
