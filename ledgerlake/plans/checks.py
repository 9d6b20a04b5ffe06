"""Cross-table reconciliation checks of a strict run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators import reconcile as RC
from ledgerlake.operators.marts import FRAUD_MONITORING_COLUMNS


def _n() -> Column:
    return F.count(F.lit(1))


#: What each mart adds up to, by the name of the measure.
MART_MEASURES = {
    "daily_transaction_summary": {"daily_rows": lambda: F.sum("transaction_count"), "daily_fraud": lambda: F.sum("fraud_count")},
    "daily_type_summary": {"daily_type_rows": lambda: F.sum("transaction_count")},
    "hourly_fraud_summary": {"hourly_rows": lambda: F.sum("transaction_count")},
    "transaction_type_summary": {"type_rows": lambda: F.sum("transaction_count")},
    "high_value_summary": {"high_value_rows": lambda: F.sum("high_value_transaction_count")},
    "fraud_monitoring": {"monitoring_rows": _n, "monitoring_content": lambda: RC.content(FRAUD_MONITORING_COLUMNS)},
    "fraud_feature": {"feature_rows": _n},
    "origin_account_summary": {"origin_rows": lambda: F.sum("origin_transaction_count")},
    "destination_account_summary": {"destination_rows": lambda: F.sum("destination_transaction_count")},
}

#: (check, expected measure, actual measure, relation).
STRICT_CHECKS = [
    ("bronze_to_silver_bound", "bronze_rows", "silver_rows", "le"),
    ("daily_count", "silver_rows", "daily_rows", "eq"),
    ("daily_type_count", "silver_rows", "daily_type_rows", "eq"),
    ("hourly_count", "silver_rows", "hourly_rows", "eq"),
    ("type_count", "silver_rows", "type_rows", "eq"),
    ("high_value_count", "silver_high_value", "high_value_rows", "eq"),
    ("daily_fraud", "silver_fraud", "daily_fraud", "eq"),
    ("fraud_monitoring_rows", "silver_fraud", "monitoring_rows", "eq"),
    ("fraud_feature_rows", "silver_rows", "feature_rows", "eq"),
    ("origin_account_count", "silver_rows", "origin_rows", "eq"),
    ("destination_account_count", "silver_rows", "destination_rows", "eq"),
]
#: Of a run's layers: every source row is in Bronze or rejected; every amount is in the sums;
#: the fraud rows of Silver are those of the mart.
LAYER_CHECKS = [
    ("bronze_source_count", "accepted_rows", "bronze_rows", "eq"),
    ("amounts_summable", "no_rows", "unsummable_rows", "eq"),
    ("fraud_monitoring_content", "silver_fraud_content", "monitoring_content", "eq"),
]
#: Of the exported fraud rows, read back from the file.
EXPORT_CHECKS = [
    ("fraud_export_rows", "monitoring_rows", "export_rows", "eq"),
    ("fraud_export_content", "monitoring_content", "export_content", "eq"),
]


def strict_reconciliation(s: DataFrame, b: DataFrame | int, gold: dict[str, DataFrame]) -> DataFrame:
    """The strict run's checks: each mart against its own Silver total.

    ``b`` is the Bronze DataFrame, or its row count when a run already observed it.
    """
    bronze_rows = (b.agg(F.count("*").alias("n")) if isinstance(b, DataFrame)
                   else s.sparkSession.range(1).select(F.lit(int(b)).cast("bigint").alias("n")))
    # One pass over Silver for its three totals (the three measures share this plan).
    silver_totals = s.agg(F.count("*").alias("rows"), F.sum("is_fraud").alias("fraud"),
                          F.sum("is_high_value_transaction").alias("high_value"))
    measures = [
        ("bronze_rows", "n", bronze_rows),
        ("silver_rows", "rows", silver_totals),
        ("silver_fraud", "fraud", silver_totals),
        ("silver_high_value", "high_value", silver_totals),
    ]
    used = {m for _, e, a, _ in STRICT_CHECKS for m in (e, a)}
    for table, own in MART_MEASURES.items():
        measures += [(name, "n", gold[table].agg(m().alias("n"))) for name, m in own.items() if name in used]
    return RC.comparison_report(measures, STRICT_CHECKS)
