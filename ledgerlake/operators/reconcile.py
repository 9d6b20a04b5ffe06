"""Reconciliation, audit records and the Gold registry as Spark DataFrames.

Cross-table comparisons are built by stacking one-row aggregates with
``unionByName`` and pivoting the sides back with conditional aggregates, so no
join or driver round trip is needed. Empty inputs count as 0 (never NULL).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.contracts import AUDIT_SCHEMA
from ledgerlake.sources.sinks import Written


def _count(df: DataFrame, label: Column, value: Column | None = None) -> DataFrame:
    """One row: (label, value) where value defaults to the row count."""
    v = F.count("*") if value is None else F.coalesce(value, F.lit(0))
    return df.agg(v.cast("bigint").alias("value")).select(label.alias("label"), "value")


def count_reconciliation(source: DataFrame, target: DataFrame) -> DataFrame:
    """source_row_count, target_row_count, row_count_difference, reconciliation_status."""
    stacked = _count(source, F.lit("source")).unionByName(_count(target, F.lit("target")))
    wide = stacked.agg(
        F.sum(F.when(F.col("label") == "source", F.col("value")).otherwise(0)).cast("bigint").alias("source_row_count"),
        F.sum(F.when(F.col("label") == "target", F.col("value")).otherwise(0)).cast("bigint").alias("target_row_count"),
    )
    return wide.select(
        "source_row_count", "target_row_count",
        (F.col("target_row_count") - F.col("source_row_count")).alias("row_count_difference"),
        F.when(F.col("source_row_count") == F.col("target_row_count"), F.lit("PASS")).otherwise(F.lit("FAIL"))
        .alias("reconciliation_status"),
    )


def partition_reconciliation(validated: DataFrame) -> DataFrame:
    """Bronze = Silver + Quarantine, in one pass over the rule-evaluated rows."""
    agg = validated.agg(
        F.count("*").alias("bronze_record_count"),
        F.count_if(F.col("hard_failure_count") == 0).alias("silver_record_count"),
        F.count_if(F.col("hard_failure_count") > 0).alias("quarantine_record_count"),
    )
    return agg.withColumn(
        "reconciliation_status",
        F.when(
            F.col("bronze_record_count") == F.col("silver_record_count") + F.col("quarantine_record_count"),
            F.lit("PASS"),
        ).otherwise(F.lit("FAIL")),
    )


def comparison_report(measures: Sequence[tuple[str, str, DataFrame]], checks: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Compare named one-row measures.

    ``measures``: (measure_name, value_column, one-row DataFrame).
    ``checks``: (check_name, expected_measure, actual_measure, relation) with
    relation ``eq`` (expected == actual) or ``le`` (0 <= actual <= expected).
    """
    stacked = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("measure"), F.coalesce(F.col(col), F.lit(0)).cast("bigint").alias("value"))
         for name, col, df in measures],
    )
    wide = stacked.agg(*[
        F.max(F.when(F.col("measure") == name, F.col("value"))).alias(name) for name, _, _ in measures
    ])
    rows = []
    for check, expected, actual, relation in checks:
        e, a = F.col(expected), F.col(actual)
        ok = (e == a) if relation == "eq" else ((a >= 0) & (a <= e))
        rows.append(F.struct(
            F.lit(check).alias("check_name"), F.lit(expected).alias("expected_measure"),
            F.lit(actual).alias("actual_measure"), e.alias("expected_value"), a.alias("actual_value"),
            F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        ))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


_REPORT_SCHEMA = "check_name string, expected_measure string, actual_measure string, expected_value long, actual_value long, status string"


def report_of_values(spark: SparkSession, values: Mapping[str, int], checks: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """The same report from measures that the writes already counted: a row per check, no table read."""
    rows = []
    for check, expected, actual, relation in checks:
        e, a = int(values.get(expected) or 0), int(values.get(actual) or 0)
        ok = e == a if relation == "eq" else 0 <= a <= e
        rows.append((check, expected, actual, e, a, "PASS" if ok else "FAIL"))
    return spark.createDataFrame(rows, _REPORT_SCHEMA)


#: Contents are compared modulo this prime, so that they fit a long.
_CONTENT = (1 << 61) - 1


def content(columns: Sequence[str]) -> Column:
    """A number for a bag of rows, whatever their order: the sum of their hashes. Equal bags have equal
    numbers; a row changed, lost or doubled changes it but for a chance of about 1 in 10**18."""
    return F.sum(F.pmod(F.xxhash64(*columns), F.lit(_CONTENT)).cast("decimal(38,0)")) % F.lit(_CONTENT)


def content_where(condition: Column, columns: Sequence[str]) -> Column:
    """The same over the rows for which ``condition`` holds."""
    hashed = F.pmod(F.xxhash64(*columns), F.lit(_CONTENT)).cast("decimal(38,0)")
    return F.sum(F.when(condition, hashed)) % F.lit(_CONTENT)


def content_reconciliation(sides: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """table_name, row_count, same_content: each side beside the first, compared row by row content."""
    first = next(iter(sides))
    parts = [df.agg(F.count("*").alias("row_count"), F.coalesce(content(columns), F.lit(0)).alias("_content")).select(
        F.lit(i).alias("_i"), F.lit(name).alias("table_name"), "row_count", "_content") for i, (name, df) in enumerate(sides.items())]
    stacked = reduce(DataFrame.unionByName, parts)
    # A row per side: the window holds as many rows as tables are compared.
    of_first = F.first(F.struct("row_count", "_content")).over(Window.partitionBy(F.lit(first)).orderBy("_i"))
    return stacked.select("table_name", "row_count", (F.struct("row_count", "_content") == of_first).alias("same_content"))


def overall_status(report: DataFrame) -> DataFrame:
    """SUCCESS when every check passes, else COMPLETED_WITH_VALIDATION_FAILURE."""
    agg = report.agg(F.count_if(F.col("status") != "PASS").alias("failed_checks"), F.count("*").alias("checks"))
    return agg.withColumn(
        "pipeline_status",
        F.when(F.col("failed_checks") == 0, F.lit("SUCCESS")).otherwise(F.lit("COMPLETED_WITH_VALIDATION_FAILURE")),
    )


def audit_record(df: DataFrame, run_id: str, stage: str, table_name: str,
                 reconciliation_status: Column | str = "PASS", execution_time_seconds: float = 0.0,
                 with_time: bool = True) -> DataFrame:
    """One audit row computed by an aggregate on the table (no driver round trip)."""
    status = F.lit(reconciliation_status) if isinstance(reconciliation_status, str) else reconciliation_status
    cols = [
        F.lit(run_id).alias("pipeline_run_id"), F.lit(stage).alias("pipeline_stage"),
        F.lit(table_name).alias("table_name"), F.count("*").cast("bigint").alias("row_count"),
        F.lit(len(df.columns)).cast("int").alias("column_count"), status.alias("reconciliation_status"),
    ]
    if with_time:
        cols += [F.lit(float(execution_time_seconds)).alias("execution_time_seconds"),
                 F.current_timestamp().alias("audit_timestamp_utc")]
    return df.agg(*cols)


def count_status(df: DataFrame, source: DataFrame) -> str:
    """PASS where both have as many rows."""
    return count_reconciliation(source, df).first()["reconciliation_status"]


def combine_audit_records(records: Sequence[DataFrame]) -> DataFrame:
    if not records:
        raise ValueError("nothing to combine: no audit rows were given")
    return reduce(DataFrame.unionByName, records)


def audit_schema_names(with_time: bool = True) -> list[str]:
    names = [f.name for f in AUDIT_SCHEMA.fields]
    return names if with_time else names[:6]


# Registry classes as the reference CLI assigns them.
SMALL_GOLD_TABLES = ["daily_transaction_summary", "daily_type_summary", "hourly_fraud_summary",
                     "transaction_type_summary", "high_value_summary"]
EXPORTED_ROW_TABLES = ["fraud_monitoring"]
LARGE_GOLD_TABLES = ["origin_account_summary", "destination_account_summary", "fraud_feature"]


def gold_registry(tables: dict[str, DataFrame], run_id: str,
                  persisted: dict[str, str] | None = None) -> DataFrame:
    """table_name, column_count, row_count, persistence_format, persistence_status.

    ``persisted`` maps table -> format for tables that were written; by default
    the CLI's split (small marts + fraud rows exported as CSV, large tables only
    defined). Row counts are aggregates over the persisted tables only.
    """
    if persisted is None:
        persisted = {t: "CSV" for t in SMALL_GOLD_TABLES + EXPORTED_ROW_TABLES}
    parts = []
    for name in sorted(tables):
        df = tables[name]
        meta = [F.lit(run_id).alias("pipeline_run_id"), F.lit(name).alias("table_name"),
                F.lit(len(df.columns)).cast("int").alias("column_count")]
        if name in persisted:
            fmt = persisted[name]
            status = "CSV_EXPORTED" if fmt == "CSV" else f"{fmt}_WRITTEN"
            parts.append(df.agg(*meta, F.count("*").cast("bigint").alias("row_count"),
                                F.lit(fmt).alias("persistence_format"), F.lit(status).alias("persistence_status")))
        else:
            status = "DEFINED_NOT_PERSISTED" if name in LARGE_GOLD_TABLES else "NOT_EXECUTED"
            # Metadata-only row: derived from the table's plan, no scan needed.
            parts.append(df.limit(0).groupBy().agg(*meta, F.lit(None).cast("bigint").alias("row_count"),
                                                    F.lit(None).cast("string").alias("persistence_format"),
                                                    F.lit(status).alias("persistence_status")))
    return reduce(DataFrame.unionByName, parts)


def _lookup(mapping: dict, key: Column) -> Column:
    """Literal map lookup (no join) for small per-table metadata."""
    return F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])[key]


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, row_count: one count per table, stacked."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").cast("bigint").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ])


def audit_from_counts(counts: DataFrame, tables: dict[str, DataFrame], stages: dict[str, str], run_id: str,
                      statuses: dict[str, str] | None = None, seconds: dict[str, float] | None = None) -> DataFrame:
    """Audit rows (AUDIT_SCHEMA order) from already counted tables.

    ``statuses`` and ``seconds`` are by table: the outcome of its own checks and
    how long its write took. A table without a check is PASS.
    """
    name = F.col("table_name")
    status = {t: (statuses or {}).get(t, "PASS") for t in tables}
    took = {t: float((seconds or {}).get(t, 0.0)) for t in tables}
    return counts.select(
        F.lit(run_id).alias("pipeline_run_id"), _lookup(stages, name).alias("pipeline_stage"), name,
        F.col("row_count"), _lookup({k: len(v.columns) for k, v in tables.items()}, name).cast("int").alias("column_count"),
        _lookup(status, name).alias("reconciliation_status"),
        _lookup(took, name).alias("execution_time_seconds"), F.current_timestamp().alias("audit_timestamp_utc"),
    )


def audit_of_writes(spark: SparkSession, tables: Mapping[str, Written], stage_of: Callable[[str], str], run_id: str,
                    statuses: Mapping[str, str]) -> DataFrame:
    """Audit rows (AUDIT_SCHEMA order) of tables as their writes counted them. A table without a check fails."""
    rows = [(run_id, stage_of(n), n, w.rows, w.columns, statuses.get(n, "FAIL"), w.seconds) for n, w in tables.items()]
    names = [f.name for f in AUDIT_SCHEMA.fields]
    df = spark.createDataFrame(rows, "run string, stage string, name string, rows long, columns int, status string, seconds double")
    return df.toDF(*names[:7]).withColumn(names[7], F.current_timestamp())


def registry_from_counts(counts: DataFrame, tables: dict[str, DataFrame], run_id: str, fmt: str) -> DataFrame:
    """Registry rows for persisted tables from already counted tables."""
    name = F.col("table_name")
    return counts.select(
        F.lit(run_id).alias("pipeline_run_id"), name,
        _lookup({k: len(v.columns) for k, v in tables.items()}, name).cast("int").alias("column_count"),
        F.col("row_count"), F.lit(fmt).alias("persistence_format"),
        F.lit("CSV_EXPORTED" if fmt == "CSV" else f"{fmt}_WRITTEN").alias("persistence_status"),
    )


def registry_of_writes(spark: SparkSession, tables: Mapping[str, Written], exports: Mapping[str, Written], run_id: str) -> DataFrame:
    """A row per mart: as it was written, and the file that holds it where it was exported too."""
    rows = [(run_id, n, w.columns, w.rows, "PARQUET", "PARQUET_WRITTEN", exports[n].path if n in exports else None,
             exports[n].rows if n in exports else None) for n, w in sorted(tables.items())]
    return spark.createDataFrame(rows, "pipeline_run_id string, table_name string, column_count int, row_count long, persistence_format string, "
                                       "persistence_status string, export_path string, exported_row_count long")
