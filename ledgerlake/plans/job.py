"""The whole run: source -> Bronze -> Silver -> Gold -> reconciliation -> audit.

Plan shape chosen for scale:

* A source is a DataFrame or the path of CSV files. A path is guarded (it holds rows, its header
  is the contract's) and parsed in full by the one write that makes Bronze, each row with the
  file it came from. Lines that don't parse fail the run or go to a table of rejects.
* Strict Silver, the ruled profile and the quality report all read Bronze.
* Silver is computed once and written as Parquet partitioned by
  ``transaction_day``; every mart reads that table (column pruning + partition
  pruning), and lineage is cut at each layer.
* Every write counts what it writes (``Observation``): rows, totals, contents. Reconciliation,
  audit, registry and summary come from these counts; no table is read again for them. Only the
  exported fraud rows are read back, to prove the file.
* Marts are grouped aggregates (partial + final), written as Parquet; marts whose size is bounded
  by the calendar (day, hour, type) and the fraud rows are also exported as named CSV files.
"""

from __future__ import annotations

import datetime
import time
import traceback
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.contracts import BRONZE_REQUIRED_COLUMNS, DEFAULT_RSD, HIGH_VALUE_THRESHOLD, validate_required_columns
from ledgerlake.functions import day_from_step, exact_amount
from ledgerlake.operators import bronze as B
from ledgerlake.operators import features as FE
from ledgerlake.operators import marts as M
from ledgerlake.operators import reconcile as RC
from ledgerlake.operators import rules as R
from ledgerlake.operators import silver as S
from ledgerlake.plans.checks import EXPORT_CHECKS, LAYER_CHECKS, MART_MEASURES, STRICT_CHECKS
from ledgerlake.sources import csv as CSV
from ledgerlake.sources.sinks import (
    Written,
    append_records,
    export_csv_file,
    files_per_value,
    spread,
    write_csv,
    write_many,
    write_parquet,
)

# Marts whose row count is bounded by the calendar or the type domain.
SMALL_MARTS = {
    "daily_transaction_summary": ["transaction_day"],
    "daily_type_summary": ["transaction_day", "transaction_type"],
    "hourly_fraud_summary": ["hourly_step"],
    "transaction_type_summary": ["transaction_type"],
    "high_value_summary": ["transaction_day", "transaction_type"],
}
#: Fraud rows that go into one named file; more become a folder of that name, which reads the same.
ONE_FILE_ROWS = 1_000_000


@dataclass(frozen=True)
class RunParams:
    run_id: str
    source_file_name: str = "events.parquet"
    high_value_threshold: float = HIGH_VALUE_THRESHOLD
    approximate_distinct_rsd: float = DEFAULT_RSD
    export_csv: bool = True
    #: Lines of a CSV source that don't parse: "fail" the run, or "reject" them.
    malformed: str = "fail"


@dataclass
class RunLog:
    """What a run has written so far, and what it counted on the way."""

    started: datetime.datetime = field(default_factory=lambda: _now())
    began: float = field(default_factory=time.perf_counter)
    tables: dict[str, Written] = field(default_factory=dict)
    values: dict[str, int] = field(default_factory=dict)
    exports: list[Written] = field(default_factory=list)

    def add(self, name: str, written: Written) -> None:
        self.tables[name] = written
        self.values.update({k: int(v or 0) for k, v in written.values.items()})

    def seconds(self) -> float:
        return round(time.perf_counter() - self.began, 3)


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)


@contextmanager
def failures_recorded(spark: SparkSession, sink: str, params: RunParams, log: RunLog) -> Iterator[None]:
    """A failed run leaves one row with its whole message and traceback, then fails."""
    try:
        yield
    except Exception as exc:
        failure = {
            "pipeline_run_id": params.run_id,
            "pipeline_status": "FAILED",
            "error_type": type(exc).__name__,
            "error_message": str(exc),
            "traceback": traceback.format_exc(),
            "run_started_at_utc": log.started,
            "failed_at_utc": _now(),
            "execution_seconds": log.seconds(),
        }
        try:
            append_records(spark.createDataFrame([failure]), f"{sink}/failures")
        finally:
            raise


# ------------------------------------------------------------------ layers

def reread(df: DataFrame, path: str) -> DataFrame:
    """What was written of ``df``, under its schema: nothing is inferred, and an empty table is a table."""
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_source(spark: SparkSession, source: DataFrame | str, params: RunParams) -> DataFrame:
    """Raw rows: a DataFrame as it is, or the guarded scan of CSV files with their names."""
    if isinstance(source, DataFrame):
        return source
    if params.malformed not in ("fail", "reject"):
        raise ValueError(f"malformed lines can fail the run or be rejected, not {params.malformed!r}")
    CSV.guard_csv(spark, source)
    read = CSV.read_csv_strict if params.malformed == "fail" else CSV.read_csv_permissive
    return CSV.with_files(read(spark, source))


def _ingest(raw: DataFrame, sink: str, path: str, params: RunParams, bronze: Callable[[DataFrame], DataFrame], log: RunLog) -> DataFrame:
    """Write a Bronze layer in the one pass over the source; count its rows before and behind rejects."""
    observation = Observation()
    permissive = CSV.CORRUPT_COLUMN in raw.columns
    rejected = F.count_if(F.col(CSV.CORRUPT_COLUMN).isNotNull()) if permissive else F.count_if(F.lit(False))
    counted = raw.observe(observation, F.count(F.lit(1)).alias("rows"), rejected.alias("rejected"))
    rows = bronze(CSV.split_rejects(counted)[0] if permissive else counted)
    written = write_parquet(rows, path)
    seen = observation.get
    n, lost = int(seen.get("rows") or 0), int(seen.get("rejected") or 0)
    if lost:  # rare, so their lines are scanned for once more instead of in every run
        rejects = CSV.split_rejects(raw)[1].withColumn("pipeline_run_id", F.lit(params.run_id))
        append_records(rejects, f"{sink}/rejects")
    log.add("bronze_transactions", written)
    log.values.update(source_rows=n, rejected_rows=lost, accepted_rows=n - lost, bronze_rows=written.rows)
    return reread(rows, path)


def bronze_stage(spark: SparkSession, source: DataFrame | str, sink: str, params: RunParams, log: RunLog | None = None) -> DataFrame:
    """Write the Bronze layer once (the only pass over the raw source); counts observed."""
    log = RunLog() if log is None else log

    def bronze(raw: DataFrame) -> DataFrame:
        rows = B.bronze_transactions(raw, params.run_id, params.source_file_name)
        validate_required_columns(rows, BRONZE_REQUIRED_COLUMNS, "bronze_dataframe")
        return rows

    return _ingest(open_source(spark, source, params), sink, f"{sink}/bronze", params, bronze, log)


def dealt_silver(bronze: DataFrame, files: dict | None, threshold: float) -> DataFrame:
    """Strict Silver, dealt by day where ``files`` are planned: the valid Bronze rows move, their features are made behind."""
    valid = S.select_valid(bronze)
    if files is not None:
        valid = spread(valid.withColumn("transaction_day", day_from_step("step")), "transaction_day", files)
    return S.silver_features(valid, threshold)


def silver_stage(spark: SparkSession, bronze: DataFrame, sink: str, params: RunParams, log: RunLog | None = None) -> DataFrame:
    """Strict Silver from Bronze, written partitioned by day; totals and contents observed on the write."""
    log = RunLog() if log is None else log
    silver = dealt_silver(bronze, files_per_value(bronze, day_from_step("step")), params.high_value_threshold)
    fraud = silver["is_fraud"] == 1
    measures = {
        "silver_rows": F.count(F.lit(1)),
        "silver_fraud": F.sum("is_fraud"),
        "silver_high_value": F.sum("is_high_value_transaction"),
        "unsummable_rows": F.count_if(F.col("amount").isNotNull() & exact_amount().isNull()),
        "silver_fraud_content": RC.content_where(fraud, M.FRAUD_MONITORING_COLUMNS),
    }
    log.add("silver_transactions", write_parquet(silver, f"{sink}/silver", partition_columns=["transaction_day"], measures=measures))
    return reread(silver, f"{sink}/silver")


def mart_measures(names) -> dict:
    """The measures that the writes of these marts count."""
    return {name: {k: make() for k, make in MART_MEASURES[name].items()} for name in names}


def write_gold(spark: SparkSession, silver: DataFrame, sink: str, rsd: float = DEFAULT_RSD, log: RunLog | None = None) -> dict[str, DataFrame]:
    """Write all nine strict marts; returns them read back from the sink.

    The passes over Silver run as concurrent jobs, then the rest: the five calendar marts come from
    one written rollup, and the feature table's hot-account decision reuses the written
    origin-account summary (rows per account) instead of another pass over Silver.
    """
    log = RunLog() if log is None else log
    base = f"{sink}/gold"
    gold = M.build_gold_tables(silver, rsd, include_features=False)
    first = {"_calendar_rollup": M.calendar_rollup(silver, rsd)}
    first |= {n: gold[n] for n in ("origin_account_summary", "destination_account_summary", "fraud_monitoring")}
    done = write_many(first, base, measures=mart_measures([n for n in first if n in gold]))
    gold.update(M.calendar_marts(reread(first["_calendar_rollup"], f"{base}/_calendar_rollup")))
    origins = reread(gold["origin_account_summary"], f"{base}/origin_account_summary")
    gold["fraud_feature"] = FE.fraud_feature(silver, origin_counts=origins)
    # The feature table first: it takes longest, and the small marts fit in beside it.
    rest = {n: gold[n] for n in sorted(set(gold) - set(first), key=lambda n: n != "fraud_feature")}
    done |= write_many(rest, base, measures=mart_measures(rest))
    for name in gold:
        log.add(name, done[name])
    return {name: reread(df, f"{base}/{name}") for name, df in gold.items()}


# ------------------------------------------------------------------ exports

def export_fraud_rows(spark: SparkSession, monitoring: DataFrame, folder: str, rows: int, log: RunLog) -> None:
    """The fraud rows as ``fraud_monitoring.csv``, read back and counted as the file holds them."""
    began = time.perf_counter()
    if rows <= ONE_FILE_ROWS:
        path = export_csv_file(monitoring, folder, "fraud_monitoring.csv", sort_by=["step", "origin_account"]).path
    else:
        path = f"{folder}/fraud_monitoring.csv"
        write_csv(monitoring, path)
    back = spark.read.option("header", True).schema(monitoring.schema).csv(path)
    seen = back.agg(F.count("*").alias("n"), RC.content(M.FRAUD_MONITORING_COLUMNS).alias("content")).first()
    log.values.update(export_rows=int(seen["n"]), export_content=int(seen["content"] or 0))
    log.exports.append(Written(path, len(monitoring.columns), int(seen["n"]), round(time.perf_counter() - began, 3)))


def export_marts(spark: SparkSession, tables: dict[str, DataFrame], sink: str, log: RunLog) -> None:
    """The small marts as named CSV files, then the fraud rows."""
    folder = f"{sink}/exports"
    for name, keys in SMALL_MARTS.items():
        log.exports.append(export_csv_file(tables[name], folder, f"{name}.csv", sort_by=keys))
    export_fraud_rows(spark, tables["fraud_monitoring"], folder, log.tables["fraud_monitoring"].rows, log)


# ------------------------------------------------------------------ reconciliation, audit, summary

# Which reconciliation checks decide a table's audit status.
TABLE_CHECKS = {
    "bronze_transactions": ["bronze_source_count"],
    "silver_transactions": ["bronze_to_silver_bound", "amounts_summable"],
    "daily_transaction_summary": ["daily_count", "daily_fraud"],
    "daily_type_summary": ["daily_type_count"],
    "hourly_fraud_summary": ["hourly_count"],
    "transaction_type_summary": ["type_count"],
    "high_value_summary": ["high_value_count"],
    "fraud_monitoring": ["fraud_monitoring_rows", "fraud_monitoring_content"],
    "fraud_feature": ["fraud_feature_rows"],
    "origin_account_summary": ["origin_account_count"],
    "destination_account_summary": ["destination_account_count"],
}


def table_statuses(report: DataFrame) -> dict[str, str]:
    """FAIL for a table of which a check failed or is missing, else PASS (the report has a dozen rows)."""
    outcome = {r["check_name"]: r["status"] for r in report.select("check_name", "status").collect()}
    return {t: "PASS" if all(outcome.get(c) == "PASS" for c in checks) else "FAIL" for t, checks in TABLE_CHECKS.items()}


def _stage_of(table: str) -> str:
    return {"bronze_transactions": "bronze", "silver_transactions": "silver"}.get(table, "gold")


def finalize_run(spark: SparkSession, sink: str, params: RunParams, log: RunLog) -> dict:
    """Reconciliation report, audit rows, registry and run summary, all from what the writes counted."""
    checks = [*STRICT_CHECKS, *LAYER_CHECKS, *(EXPORT_CHECKS if log.exports else [])]
    report = RC.report_of_values(spark, log.values, checks)
    write_parquet(report.coalesce(1), f"{sink}/reconciliation/run_id={params.run_id}")
    statuses = table_statuses(report)
    append_records(RC.audit_of_writes(spark, log.tables, _stage_of, params.run_id, statuses), f"{sink}/audit")
    gold = {name: w for name, w in log.tables.items() if _stage_of(name) == "gold"}
    exported = {w.path.rsplit("/", 1)[-1].removesuffix(".csv"): w for w in log.exports}
    write_parquet(RC.registry_of_writes(spark, gold, exported, params.run_id), f"{sink}/registry/run_id={params.run_id}")
    passed = all(r["status"] == "PASS" for r in report.collect())
    v = log.values
    summary = {
        "pipeline_run_id": params.run_id,
        "pipeline_status": "SUCCESS" if passed else "COMPLETED_WITH_VALIDATION_FAILURE",
        "run_started_at_utc": log.started,
        "run_completed_at_utc": _now(),
        "total_execution_seconds": log.seconds(),
        "source_row_count": v["source_rows"],
        "rejected_line_count": v["rejected_rows"],
        "bronze_row_count": v["bronze_rows"],
        "silver_row_count": v["silver_rows"],
        "fraud_transaction_count": v["silver_fraud"],
        "rejected_row_count": v["bronze_rows"] - v["silver_rows"],
        "gold_tables_written": len(gold),
        "csv_files_exported": len(log.exports),
        "large_gold_tables_skipped": len(set(gold) - set(exported)),
        "overall_reconciliation_status": "PASS" if passed else "FAIL",
    }
    append_records(spark.createDataFrame([summary], _SUMMARY_SCHEMA), f"{sink}/summary")
    return summary


_SUMMARY_SCHEMA = (
    "pipeline_run_id string, pipeline_status string, run_started_at_utc timestamp_ntz, run_completed_at_utc timestamp_ntz, "
    "total_execution_seconds double, source_row_count long, rejected_line_count long, bronze_row_count long, "
    "silver_row_count long, fraud_transaction_count long, rejected_row_count long, gold_tables_written int, "
    "csv_files_exported int, large_gold_tables_skipped int, overall_reconciliation_status string"
)


def run(spark: SparkSession, source: DataFrame | str, sink: str, params: RunParams) -> dict:
    """Run the strict pipeline into ``sink``; returns the run summary as a dict.

    ``source`` is a raw DataFrame or the path of the raw CSV files.
    """
    sink, log = sink.rstrip("/"), RunLog()
    with failures_recorded(spark, sink, params, log):
        bronze = bronze_stage(spark, source, sink, params, log)
        silver = silver_stage(spark, bronze, sink, params, log)
        tables = write_gold(spark, silver, sink, params.approximate_distinct_rsd, log)
        if params.export_csv:
            export_marts(spark, tables, sink, log)
        return finalize_run(spark, sink, params, log)


# ------------------------------------------------------------------ the ruled run

# Single-aggregate forms of the ruled marts (the run uses the rollup in write_ruled_gold).
RULED_MARTS = {
    "daily_transaction_summary": M.daily_transaction_summary_exact,
    "hourly_fraud_summary": M.hourly_fraud_profile,
    "transaction_type_summary": M.transaction_type_profile,
    "origin_account_summary": M.origin_account_profile,
    "destination_account_summary": M.destination_account_profile,
    "high_value_summary": M.high_value_profile,
    "fraud_monitoring": M.fraud_monitoring_profile,
    "daily_type_summary": M.daily_type_profile,
}

#: What each ruled mart adds up to.
RULED_MEASURES = {
    "daily_transaction_summary": {"daily_rows": lambda: F.sum("transaction_count")},
    "daily_type_summary": {"daily_type_rows": lambda: F.sum("transaction_count")},
    "hourly_fraud_summary": {"hourly_rows": lambda: F.sum("transaction_count")},
    "transaction_type_summary": {"type_rows": lambda: F.sum("transaction_count")},
    "origin_account_summary": {"origin_rows": lambda: F.sum("transaction_count")},
    "destination_account_summary": {"destination_rows": lambda: F.sum("received_transaction_count")},
    "high_value_summary": {"high_value_rows": lambda: F.sum("high_value_transaction_count")},
    "fraud_monitoring": {"monitoring_rows": lambda: F.count(F.lit(1))},
    "fraud_features": {"feature_rows": lambda: F.count(F.lit(1))},
}
RULED_CHECKS = [
    ("bronze_source_count", "accepted_rows", "bronze_rows", "eq"),
    ("bronze_split", "bronze_rows", "split_rows", "eq"),
    ("daily_count", "silver_rows", "daily_rows", "eq"),
    ("daily_type_count", "silver_rows", "daily_type_rows", "eq"),
    ("hourly_count", "silver_rows", "hourly_rows", "eq"),
    ("type_count", "silver_rows", "type_rows", "eq"),
    ("high_value_count", "silver_high_value", "high_value_rows", "eq"),
    ("fraud_monitoring_rows", "silver_fraud", "monitoring_rows", "eq"),
    ("fraud_feature_rows", "silver_rows", "feature_rows", "eq"),
    ("origin_account_count", "silver_rows", "origin_rows", "eq"),
    ("destination_account_count", "silver_rows", "destination_rows", "eq"),
]


def ruled_bronze_stage(spark: SparkSession, source: DataFrame | str, sink: str, params: RunParams, log: RunLog | None = None) -> DataFrame:
    """The ruled Bronze layer: raw names, extended lineage, record hash; written once, counts observed."""
    log = RunLog() if log is None else log
    return _ingest(open_source(spark, source, params), sink, f"{sink}/bronze_ruled", params,
                   lambda raw: B.bronze_ruled(raw, params.run_id, params.source_file_name), log)


def write_validated(spark: SparkSession, bronze: DataFrame, sink: str, params: RunParams, log: RunLog | None = None) -> DataFrame:
    """Evaluate the rules once over a ruled Bronze layer and write every row, partitioned by validation status.

    The three statuses are three folders that each task writes its own share of, without a shuffle.
    Counts by rule and status are observed on the write.
    """
    log = RunLog() if log is None else log
    valid = F.col("hard_failure_count") == 0
    measures = {
        "silver_rows": F.count_if(valid), "quarantine_rows": F.count_if(~valid),
        "warning_rows": F.count_if(valid & (F.col("warning_count") > 0)),
        "silver_fraud": F.sum(F.when(valid, F.col("is_fraud"))),
        "silver_high_value": F.sum(F.when(valid, F.col("is_high_value_transaction"))),
    }
    counts = {f"hard:{r.code}": F.sum(r.column) for r in R.hard_rules()}
    counts |= {f"warning:{r.code}": F.sum(F.when(valid, F.col(r.column))) for r in R.warning_rules()}
    observation = Observation()
    rows = R.validated_bronze(bronze, params.high_value_threshold).observe(
        observation, *[m.cast("bigint").alias(k) for k, m in {**measures, **counts}.items()]
    )
    keep = list(dict.fromkeys(R.SILVER_RULED_COLUMNS + R.QUARANTINE_COLUMNS))
    rows = rows.select(*keep)
    log.add("validated_transactions", write_parquet(rows, f"{sink}/validated", partition_columns=["validation_status"]))
    log.values.update({k: int(v or 0) for k, v in observation.get.items()})
    log.values["split_rows"] = log.values["silver_rows"] + log.values["quarantine_rows"]
    return reread(rows, f"{sink}/validated")


def silver_ruled_view(validated: DataFrame) -> DataFrame:
    """Valid rows: partition pruning skips the QUARANTINE directory."""
    return validated.filter(F.col("validation_status") != "QUARANTINE").select(*R.SILVER_RULED_COLUMNS)


def quarantine_view(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("validation_status") == "QUARANTINE").select(*R.QUARANTINE_COLUMNS)


def write_ruled_gold(spark: SparkSession, silver: DataFrame, sink: str, log: RunLog | None = None) -> None:
    """Ruled marts: the five calendar marts from three small written aggregates (one
    additive rollup, one distinct-account pass, the type medians), the account
    profiles and fraud rows as concurrent jobs, then the features (hot accounts
    from the written origin profile)."""
    log = RunLog() if log is None else log
    base = f"{sink}/gold_ruled"
    first = {
        "_calendar_rollup": M.ruled_calendar_rollup(silver),
        "_distinct_accounts": M.ruled_distinct_accounts(silver),
        "_type_medians": M.ruled_type_medians(silver),
        "origin_account_summary": M.origin_account_profile(silver),
        "destination_account_summary": M.destination_account_profile(silver),
        "fraud_monitoring": M.fraud_monitoring_profile(silver),
    }

    def measures(names) -> dict:
        return {n: {k: make() for k, make in RULED_MEASURES[n].items()} for n in names if n in RULED_MEASURES}

    def read(name: str) -> DataFrame:
        return reread(first[name], f"{base}/{name}")

    done = write_many(first, base, measures=measures(first))
    calendar = M.ruled_calendar_marts(read("_calendar_rollup"), read("_distinct_accounts"), read("_type_medians"))
    done |= write_many(calendar, base, measures=measures(calendar))
    features = FE.fraud_feature_profile(silver, origin_counts=read("origin_account_summary"))
    done["fraud_features"] = write_parquet(features, f"{base}/fraud_features", measures=measures(["fraud_features"])["fraud_features"])
    for name, written in done.items():
        if not name.startswith("_"):
            log.add(name, written)


def _rule_files(spark: SparkSession, sink: str, log: RunLog) -> None:
    """Counts by rule (hard failures of all rows, warnings of valid ones) and by status, as named CSV files."""
    folder, v = f"{sink}/quality_ruled", log.values
    for kind, rules in (("hard", R.hard_rules()), ("warning", R.warning_rules())):
        rows = [(kind.upper(), r.code, i + 1, v[f"{kind}:{r.code}"]) for i, r in enumerate(rules)]
        table = spark.createDataFrame(rows, "rule_kind string, rule_code string, rule_order int, failed_records long")
        log.exports.append(export_csv_file(table, folder, f"{'hard_failure' if kind == 'hard' else kind}_counts.csv", sort_by=["rule_order"]))
    statuses = [("VALID", v["silver_rows"] - v["warning_rows"]), ("VALID_WITH_WARNING", v["warning_rows"]), ("QUARANTINE", v["quarantine_rows"])]
    log.exports.append(export_csv_file(spark.createDataFrame(statuses, "validation_status string, record_count long"), folder,
                                       "validation_status_counts.csv", sort_by=["validation_status"]))


def stage_audits(log: RunLog, params: RunParams, duplicates: int) -> dict[str, dict]:
    """One wide record per stage of the ruled run: its counts, its checks, its time."""
    v, t = log.values, log.tables

    def record(name: str, counts: dict, checks: dict[str, bool], tables: list[str]) -> dict:
        return {
            "pipeline_run_id": params.run_id, "pipeline_name": name, **counts, **checks,
            "duration_seconds": round(sum(t[x].seconds for x in tables), 3),
            "pipeline_status": "SUCCESS" if all(checks.values()) else "FAILED",
        }

    marts = [n for n in RULED_MEASURES]
    return {
        "raw_to_bronze": record(
            "raw_to_bronze",
            {"source_record_count": v["source_rows"], "rejected_record_count": v["rejected_rows"],
             "bronze_record_count": v["bronze_rows"], "duplicate_record_count": duplicates},
            {"count_reconciliation_passed": v["accepted_rows"] == v["bronze_rows"]}, ["bronze_transactions"]),
        "bronze_to_silver": record(
            "bronze_to_silver",
            {"bronze_record_count": v["bronze_rows"], "silver_record_count": v["silver_rows"],
             "quarantine_record_count": v["quarantine_rows"], "warning_record_count": v["warning_rows"]},
            {"count_reconciliation_passed": v["bronze_rows"] == v["split_rows"]}, ["validated_transactions"]),
        "silver_to_gold": record(
            "silver_to_gold", {"silver_record_count": v["silver_rows"], **{f"{n}_row_count": t[n].rows for n in marts}},
            {"daily_reconciliation_passed": v["silver_rows"] == v["daily_rows"],
             "hourly_reconciliation_passed": v["silver_rows"] == v["hourly_rows"],
             "type_reconciliation_passed": v["silver_rows"] == v["type_rows"],
             "fraud_reconciliation_passed": v["silver_fraud"] == v["monitoring_rows"]}, marts),
    }


def run_ruled(spark: SparkSession, source: DataFrame | str, sink: str, params: RunParams) -> dict:
    """Ruled profile: Bronze, one rule pass, Silver/Quarantine views, the wide marts, their audit; returns the summary."""
    sink, log = sink.rstrip("/"), RunLog()
    with failures_recorded(spark, sink, params, log):
        bronze = ruled_bronze_stage(spark, source, sink, params, log)
        validated = write_validated(spark, bronze, sink, params, log)
        write_ruled_gold(spark, silver_ruled_view(validated), sink, log)
        if params.export_csv:
            _rule_files(spark, sink, log)
        groups = bronze.groupBy("_record_hash").agg(F.count("*").alias("n"))
        duplicates = groups.agg(F.coalesce(F.sum("n") - F.count("*"), F.lit(0)).alias("d")).first()["d"]
        for name, audit in stage_audits(log, params, duplicates).items():
            append_records(spark.createDataFrame([audit]), f"{sink}/audit_ruled/{name}")
        report = RC.report_of_values(spark, log.values, RULED_CHECKS)
        write_parquet(report.coalesce(1), f"{sink}/reconciliation_ruled/run_id={params.run_id}")
        passed = all(r["status"] == "PASS" for r in report.collect())
        v = log.values
        summary = {
            "pipeline_run_id": params.run_id,
            "pipeline_status": "SUCCESS" if passed else "COMPLETED_WITH_VALIDATION_FAILURE",
            "run_started_at_utc": log.started,
            "run_completed_at_utc": _now(),
            "total_execution_seconds": log.seconds(),
            "bronze_record_count": v["bronze_rows"],
            "silver_record_count": v["silver_rows"],
            "quarantine_record_count": v["quarantine_rows"],
            "warning_record_count": v["warning_rows"],
            "fraud_transaction_count": v["silver_fraud"],
            "gold_tables_written": len(RULED_MEASURES),
            "csv_files_exported": len(log.exports),
            "reconciliation_status": "PASS" if passed else "FAIL",
        }
        append_records(spark.createDataFrame([summary]), f"{sink}/summary_ruled")
        return summary


# ------------------------------------------------------------------ run helpers

def new_run_id() -> str:
    """``YYYYmmdd_HHMMSS_<8 hex>`` in UTC."""
    import uuid

    now = datetime.datetime.now(datetime.timezone.utc)
    return f"{now:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def write_quality_reports(raw: DataFrame, sink: str) -> list[str]:
    """The profiling report tables, each as one CSV (all are bounded by columns, types or steps)."""
    from ledgerlake.operators import quality as Q

    reports = {
        "quality_report": (Q.quality_report(raw), ["status", "severity", "check_category", "check_name"]),
        "missing_value_summary": (Q.null_profile_long(raw), ["column_name"]),
        "cardinality_profile": (Q.cardinality_profile(raw), [F.desc("cardinality_pct")]),
        "transaction_type_profile": (Q.type_quality_profile(raw), ["type"]),
        "hourly_profile": (Q.hourly_profile(raw), ["step"]),
        "fraud_by_transaction_type": (Q.fraud_by_type(raw), [F.desc("fraud_rate_pct"), "type"]),
    }
    paths = []
    for name, (df, order) in reports.items():
        paths.append(export_csv_file(df, f"{sink.rstrip('/')}/quality", f"{name}.csv", sort_by=order).path)
    return paths


# Descriptive registry of the strict marts (fixed documentation text).
GOLD_TABLE_DESCRIPTIONS = [
    ("daily_transaction_summary", "transaction_day", "Daily volume, value, fraud and high-value activity", "one row per day"),
    ("daily_type_summary", "transaction_day, transaction_type", "Daily activity per transaction type", "days x types"),
    ("hourly_fraud_summary", "step", "Hourly volume and fraud rate", "one row per hour"),
    ("transaction_type_summary", "transaction_type", "Activity and fraud per transaction type", "one row per type"),
    ("origin_account_summary", "origin_account", "Sending-account activity", "one row per origin account"),
    ("destination_account_summary", "destination_account", "Receiving-account activity", "one row per destination account"),
    ("high_value_summary", "transaction_day, transaction_type", "High-value transactions per day and type", "days x types"),
    ("fraud_monitoring", "transaction", "Fraudulent transactions for review", "one row per fraud transaction"),
    ("fraud_feature", "transaction", "Leakage-free prior-history features", "one row per Silver transaction"),
]


def describe_gold_tables(spark: SparkSession) -> DataFrame:
    """Descriptive registry: table, grain, purpose, expected size (documentation, not data)."""
    return spark.createDataFrame(GOLD_TABLE_DESCRIPTIONS, "table_name string, grain string, purpose string, expected_size string")


EXPECTED_OUTPUTS = ["bronze", "silver", "gold/daily_transaction_summary", "gold/daily_type_summary",
                    "gold/hourly_fraud_summary", "gold/transaction_type_summary", "gold/high_value_summary",
                    "gold/fraud_monitoring", "audit", "summary"]


def validate_outputs(spark: SparkSession, sink: str, expected: list[str] = EXPECTED_OUTPUTS) -> dict[str, bool]:
    """Each expected output exists and holds at least one row (reads one row per output)."""
    status = {}
    for name in expected:
        try:
            status[name] = not spark.read.parquet(f"{sink.rstrip('/')}/{name}").limit(1).isEmpty()
        except Exception:  # noqa: BLE001 - missing output
            status[name] = False
    return status


def latest_run_status(spark: SparkSession, sink: str) -> dict | None:
    """The newest run summary must be SUCCESS with PASS reconciliation (one row read)."""
    summaries = spark.read.parquet(f"{sink.rstrip('/')}/summary")
    row = summaries.orderBy(F.desc("pipeline_run_id")).limit(1).first()
    if row is None:
        return None
    d = row.asDict()
    d["healthy"] = d.get("pipeline_status") == "SUCCESS" and d.get("overall_reconciliation_status") == "PASS"
    return d
