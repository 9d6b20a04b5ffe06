"""The SQL surface: Spark SQL text over DataFrames.

``spark.sql(text, t=df)`` binds each DataFrame as a query-scoped view, so no
session-global temp view names are needed and Catalyst plans the text exactly
like the DataFrame API. Percentages are computed in exact decimal arithmetic
(``100.0 * ...``) and returned as double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def sql_type_summary(raw: DataFrame) -> DataFrame:
    return raw.sparkSession.sql(
        """
        SELECT type AS transaction_type, COUNT(*) AS transaction_count,
               ROUND(SUM(amount), 2) AS total_amount, ROUND(AVG(amount), 2) AS average_amount,
               SUM(isFraud) AS fraud_count,
               CAST(ROUND(100.0 * SUM(isFraud) / COUNT(*), 6) AS DOUBLE) AS fraud_rate_pct
        FROM {t}
        GROUP BY type
        ORDER BY fraud_rate_pct DESC, transaction_type
        """,
        t=raw,
    )


def top_fraud(raw: DataFrame, k: int = 10) -> DataFrame:
    """Largest fraud rows; the limit is the feature (TakeOrderedAndProject)."""
    return raw.sparkSession.sql(
        f"""
        SELECT step, type, amount, nameOrig, nameDest, isFlaggedFraud
        FROM {{t}}
        WHERE isFraud = 1
        ORDER BY amount DESC, step ASC, nameOrig ASC, nameDest ASC
        LIMIT {int(k)}
        """,
        t=raw,
    )


def sql_hourly_summary(raw: DataFrame) -> DataFrame:
    return raw.sparkSession.sql(
        """
        SELECT step, COUNT(*) AS transaction_count, ROUND(SUM(amount), 2) AS total_amount,
               SUM(isFraud) AS fraud_count,
               CAST(ROUND(100.0 * SUM(isFraud) / COUNT(*), 6) AS DOUBLE) AS fraud_rate_pct
        FROM {t}
        GROUP BY step
        ORDER BY step
        """,
        t=raw,
    )


def sql_bronze_type_counts(bronze_ruled: DataFrame) -> DataFrame:
    return bronze_ruled.sparkSession.sql(
        "SELECT type, COUNT(*) AS transaction_count, SUM(isFraud) AS fraud_count FROM {t} GROUP BY type "
        "ORDER BY transaction_count DESC, type",
        t=bronze_ruled,
    )


def sql_silver_type_summary(silver_ruled: DataFrame) -> DataFrame:
    return silver_ruled.sparkSession.sql(
        """
        SELECT transaction_type, COUNT(*) AS transaction_count, ROUND(SUM(amount), 2) AS total_amount,
               SUM(is_fraud) AS fraud_count,
               CAST(ROUND(100.0 * SUM(is_fraud) / COUNT(*), 6) AS DOUBLE) AS fraud_rate_pct
        FROM {t}
        GROUP BY transaction_type
        ORDER BY transaction_count DESC, transaction_type
        """,
        t=silver_ruled,
    )


def sql_status_summary(silver_ruled: DataFrame) -> DataFrame:
    return silver_ruled.sparkSession.sql(
        "SELECT validation_status, COUNT(*) AS record_count, SUM(is_fraud) AS fraud_count FROM {t} GROUP BY validation_status "
        "ORDER BY record_count DESC, validation_status",
        t=silver_ruled,
    )


def sql_gold_type_lookup(type_profile: DataFrame) -> DataFrame:
    return type_profile.sparkSession.sql(
        """
        SELECT transaction_type, transaction_count, total_amount, fraud_count, fraud_amount, fraud_rate_pct
        FROM {t}
        ORDER BY transaction_count DESC, transaction_type
        """,
        t=type_profile,
    )
