import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fixtures import NULLABLE_RAW_SCHEMA
from ledgerlake.contracts import AUDIT_SCHEMA
from ledgerlake.operators import reconcile as RC
from ledgerlake.plans import catalog as C
from ledgerlake.plans import job as J
from ledgerlake.sources import csv as CSV
from ledgerlake.sources import sinks as K


def _scratch():
    return tempfile.mkdtemp(prefix="ledgerlake-test-")


def test_audit_record_schema_and_count(spark):
    df = spark.range(5).withColumn("value", F.lit("x"))
    rec = RC.audit_record(df, "run_1", "gold", "t", execution_time_seconds=1.5)
    assert rec.columns == [f.name for f in AUDIT_SCHEMA.fields]
    row = rec.first()
    assert (row.row_count, row.column_count, row.reconciliation_status) == (5, 2, "PASS")


def test_combine_audit_records(spark):
    a = RC.audit_record(spark.range(2), "r", "s", "a")
    b = RC.audit_record(spark.range(3), "r", "s", "b")
    assert RC.combine_audit_records([a, b]).count() == 2
    with pytest.raises(ValueError):
        RC.combine_audit_records([])


def test_small_export_is_one_csv_file(spark):
    path = os.path.join(_scratch(), "out")
    df = spark.range(10).withColumn("id2", F.col("id") * 2)
    K.export_small_table(df, path, sort_by=["id"])
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(parts) == 1
    back = spark.read.option("header", True).schema(df.schema).csv(path)
    assert [r.id for r in back.collect()] == list(range(10))


def test_named_export_is_the_one_file(spark):
    folder = os.path.join(_scratch(), "exports")
    for n in (10, 4):  # the second replaces the first
        df = spark.range(n).repartition(3).withColumn("name", F.concat(F.lit(" a,"), F.col("id")))
        written = K.export_csv_file(df, folder, "ids.csv", sort_by=["id"])
        assert written.rows == n and written.columns == 2
        assert sorted(f for f in os.listdir(folder) if not f.startswith(".")) == ["ids.csv"]
    with open(os.path.join(folder, "ids.csv")) as fh:
        assert fh.read().splitlines() == ["id,name", '0," a,0"', '1," a,1"', '2," a,2"', '3," a,3"']
    back = spark.read.option("header", True).schema(df.schema).csv(written.path)
    assert back.exceptAll(df).count() == 0
    assert K.export_csv_file(df.limit(0), folder, "none.csv").rows == 0


def test_failed_export_leaves_the_file(spark):
    folder = os.path.join(_scratch(), "exports")
    K.export_csv_file(spark.range(3), folder, "ids.csv")
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception):
        K.export_csv_file(bad, folder, "ids.csv")
    assert spark.read.option("header", True).csv(os.path.join(folder, "ids.csv")).count() == 3


def test_writes_count_what_they_write(spark):
    folder = _scratch()
    df = spark.range(100).repartition(5).withColumn("v", F.col("id") % 7)
    w = K.write_parquet(df, os.path.join(folder, "a"), measures={"total": F.sum("v"), "big": F.count_if(F.col("v") > 5)})
    assert (w.rows, w.columns, w.values) == (100, 2, {"total": sum(i % 7 for i in range(100)), "big": 14})
    assert K.write_parquet(df.filter("id < 0"), os.path.join(folder, "b"), measures={"total": F.sum("v")}).rows == 0
    many = K.write_many({"x": df, "y": df.limit(3)}, folder, measures={"y": {"n": F.count("v")}})
    assert many["x"].rows == 100 and many["y"].values == {"n": 3}


def test_files_follow_the_rows_of_a_value(spark):
    folder = _scratch()
    hot = spark.range(0, 9000, 1, 12).withColumn("day", F.when(F.col("id") % 9 > 0, 1).otherwise((F.col("id") % 5).cast("int") + 2).cast("int"))
    files = K.files_per_value(hot, F.col("day"), rows_per_file=2000)
    assert files == {1: 4, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1}  # twelve tasks with six days each would leave 72 files
    w = K.write_parquet(hot, os.path.join(folder, "t"), partition_columns=["day"], files=files, measures={"n": F.count("day")})
    assert w.rows == 9000 and w.values == {"n": 9000}
    assert spark.read.parquet(w.path).groupBy("day").count().filter("day = 1").first()["count"] == 8000
    plan = K.spread(hot, "day", files)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(day" in plan and "_salt" in plan
    # a source in time order holds few days a task: no shuffle
    ordered = spark.range(0, 9000, 1, 12).withColumn("day", (F.col("id") / 1500).cast("int"))
    assert K.files_per_value(ordered, F.col("day"), rows_per_file=2000) is None


def test_partitioned_writes_shuffle_nothing_by_few_values(spark):
    sink = _scratch()
    log = J.RunLog()
    bronze = J.ruled_bronze_stage(spark, C.raw(spark, SF_SMALL), sink, J.RunParams(run_id="r"), log)
    J.write_validated(spark, bronze, sink, J.RunParams(run_id="r"), log)
    plan = J.R.validated_bronze(bronze)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "rebalance" not in plan.lower()
    assert log.values["silver_rows"] + log.values["quarantine_rows"] == log.values["bronze_rows"] == 1002


def test_parquet_partitioned_roundtrip(spark):
    path = os.path.join(_scratch(), "pq")
    df = spark.range(20).withColumn("day", (F.col("id") % 3).cast("int"))
    K.write_parquet(df, path, partition_columns=["day"])
    assert {"day=0", "day=1", "day=2", "_SUCCESS"} <= set(os.listdir(path))
    assert spark.read.parquet(path).count() == 20


def _write_csv(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part.csv"), "w") as fh:
        fh.write(text)


HEADER = "step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,oldbalanceDest,newbalanceDest,isFraud,isFlaggedFraud\n"


def test_strict_csv_raises_only_when_columns_are_parsed(spark):
    path = os.path.join(_scratch(), "bad")
    _write_csv(path, HEADER + "1,PAYMENT,10.0,C1,5.0,0.0,M1,0.0,0.0,0,0\n2,PAYMENT,oops,C1,5.0,0.0,M1,0.0,0.0,0,0\n")
    df = CSV.read_csv_strict(spark, path)
    assert df.count() == 2  # a pruned count parses no column
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        CSV.validate_all_columns(df)


def test_strict_csv_rejects_renamed_header(spark):
    path = os.path.join(_scratch(), "renamed")
    _write_csv(path, HEADER.replace("amount", "amt") + "1,PAYMENT,10.0,C1,5.0,0.0,M1,0.0,0.0,0,0\n")
    with pytest.raises(Exception):
        CSV.validate_all_columns(CSV.read_csv_strict(spark, path))


def test_permissive_csv_keeps_bad_line(spark):
    path = os.path.join(_scratch(), "permissive")
    _write_csv(path, HEADER + "2,PAYMENT,oops,C1,5.0,0.0,M1,0.0,0.0,0,0\n")
    row = CSV.read_csv_permissive(spark, path).first()
    assert row.amount is None and row[CSV.CORRUPT_COLUMN].startswith("2,PAYMENT,oops")


def test_source_guard(spark):
    assert CSV.source_is_readable(spark, f"{SF_SMALL}/events.parquet", fmt="parquet")
    assert not CSV.source_is_readable(spark, os.path.join(_scratch(), "missing"), fmt="parquet")


def test_job_run_end_to_end(spark):
    sink = os.path.join(_scratch(), "run")
    summary = J.run(spark, C.raw(spark, SF_SMALL), sink, J.RunParams(run_id="test_run"))
    assert summary["pipeline_status"] == "SUCCESS"
    assert summary["bronze_row_count"] == 1002 and summary["silver_row_count"] == 946
    assert summary["run_started_at_utc"] <= summary["run_completed_at_utc"]
    assert (summary["gold_tables_written"], summary["csv_files_exported"], summary["large_gold_tables_skipped"]) == (9, 6, 3)
    audit = spark.read.parquet(f"{sink}/audit")
    assert audit.count() == 11 and audit.filter("table_name = 'bronze_transactions' AND row_count = 1002").count() == 1
    assert audit.filter("reconciliation_status <> 'PASS' OR execution_time_seconds <= 0").count() == 0
    counts = {r.table_name: r.row_count for r in audit.collect()}
    for name in [n for n in counts if n not in ("bronze_transactions", "silver_transactions")]:
        assert spark.read.parquet(f"{sink}/gold/{name}").count() == counts[name], name
    registry = spark.read.parquet(f"{sink}/registry/run_id=test_run")
    assert registry.count() == 9 and registry.filter("persistence_status = 'PARQUET_WRITTEN'").count() == 9
    assert registry.filter("export_path IS NOT NULL AND exported_row_count = row_count").count() == 6
    assert spark.read.parquet(f"{sink}/summary").first().pipeline_status == "SUCCESS"
    exported = spark.read.option("header", True).csv(f"{sink}/exports/daily_transaction_summary.csv")
    assert exported.count() == 31
    report = spark.read.parquet(f"{sink}/reconciliation/run_id=test_run")
    assert report.count() == 16 and report.filter("status <> 'PASS'").count() == 0


def _source_csv(spark, rows=None):
    path = os.path.join(_scratch(), "source")
    K.write_csv((C.raw(spark, SF_SMALL) if rows is None else rows).repartition(3), path)
    return path


def test_job_from_csv_files(spark):
    sink = os.path.join(_scratch(), "run")
    summary = J.run(spark, _source_csv(spark), sink, J.RunParams(run_id="csv", export_csv=False))
    assert summary["pipeline_status"] == "SUCCESS" and summary["source_row_count"] == summary["bronze_row_count"] == 1002
    assert summary["csv_files_exported"] == 0 and summary["large_gold_tables_skipped"] == 9
    names = [r.source_file_name for r in spark.read.parquet(f"{sink}/bronze").select("source_file_name").distinct().collect()]
    assert len(names) == 3 and all(n.startswith("part-") and n.endswith(".csv") for n in names)
    ruled = J.run_ruled(spark, _source_csv(spark), sink, J.RunParams(run_id="csv"))
    assert (ruled["silver_record_count"], ruled["quarantine_record_count"], ruled["reconciliation_status"]) == (936, 66, "PASS")
    path = spark.read.parquet(f"{sink}/bronze_ruled").select("_source_file_path", "_source_file").first()
    assert path._source_file_path.startswith("file:") and path._source_file_path.endswith(path._source_file)


def test_malformed_lines_fail_or_are_rejected(spark):
    broken = C.raw(spark, SF_SMALL).withColumn("amount", F.when(F.col("step").isNull(), "oops").otherwise(F.col("amount").cast("string")))
    lost = broken.filter("amount = 'oops'").count()
    path, sink = _source_csv(spark, broken), os.path.join(_scratch(), "run")
    assert lost > 0
    with pytest.raises(Exception):
        J.run(spark, path, sink, J.RunParams(run_id="strict"))
    assert spark.read.parquet(f"{sink}/failures").first().pipeline_status == "FAILED"
    summary = J.run(spark, path, sink, J.RunParams(run_id="lenient", malformed="reject"))
    assert summary["pipeline_status"] == "SUCCESS" and summary["rejected_line_count"] == lost
    assert summary["bronze_row_count"] == 1002 - lost
    rejects = spark.read.parquet(f"{sink}/rejects")
    assert rejects.count() == lost and rejects.filter(F.col(CSV.CORRUPT_COLUMN).contains("oops") & F.col(CSV.SCANNED_PATH).isNotNull()).count() == lost
    with pytest.raises(ValueError):
        J.run(spark, path, sink, J.RunParams(run_id="other", malformed="keep"))


def test_unusable_sources_stop_a_run(spark):
    folder = _scratch()
    _write_csv(os.path.join(folder, "renamed"), HEADER.replace("amount", "amt") + "1,PAYMENT,10.0,C1,5.0,0.0,M1,0.0,0.0,0,0\n")
    _write_csv(os.path.join(folder, "empty"), HEADER)
    for name in ("missing", "renamed", "empty"):
        with pytest.raises(CSV.UnusableSource):
            J.run(spark, os.path.join(folder, name), os.path.join(folder, "out"), J.RunParams(run_id=name))
    failures = spark.read.parquet(os.path.join(folder, "out", "failures"))
    assert {r.error_type for r in failures.collect()} == {"UnusableSource"} and failures.count() == 3


def test_a_changed_export_fails_the_run(spark, monkeypatch):
    sink = os.path.join(_scratch(), "run")
    real = J.export_csv_file

    def change(df, folder, name, sort_by=None):
        if name == "fraud_monitoring.csv":
            df = df.withColumn("amount", F.when(F.col("amount") == df.agg(F.max("amount")).first()[0], 1.0).otherwise(F.col("amount")))
        return real(df, folder, name, sort_by)

    monkeypatch.setattr(J, "export_csv_file", change)
    summary = J.run(spark, C.raw(spark, SF_SMALL), sink, J.RunParams(run_id="changed"))
    assert summary["pipeline_status"] != "SUCCESS" and summary["overall_reconciliation_status"] == "FAIL"
    failed = spark.read.parquet(f"{sink}/reconciliation/run_id=changed").filter("status = 'FAIL'")
    assert [r.check_name for r in failed.collect()] == ["fraud_export_content"]


def test_many_fraud_rows_become_a_folder(spark, monkeypatch):
    sink = os.path.join(_scratch(), "run")
    monkeypatch.setattr(J, "ONE_FILE_ROWS", 3)
    assert J.run(spark, C.raw(spark, SF_SMALL), sink, J.RunParams(run_id="many"))["pipeline_status"] == "SUCCESS"
    assert os.path.isdir(f"{sink}/exports/fraud_monitoring.csv")


def test_infinite_amounts_are_told(spark):
    rows = C.raw(spark, SF_SMALL)
    rows = rows.withColumn("amount", F.when(F.col("amount") == 200000, float("inf")).otherwise(F.col("amount")))
    sink = os.path.join(_scratch(), "run")
    assert J.run(spark, rows, sink, J.RunParams(run_id="inf", export_csv=False))["pipeline_status"] != "SUCCESS"
    report = {r.check_name: r.status for r in spark.read.parquet(f"{sink}/reconciliation/run_id=inf").collect()}
    assert report["amounts_summable"] == "FAIL" and report["daily_count"] == "PASS"


def test_job_records_failures(spark):
    sink = os.path.join(_scratch(), "fail")
    bad = spark.createDataFrame([(1, "PAYMENT")], "step int, type string")
    with pytest.raises(ValueError):
        J.run(spark, bad, sink, J.RunParams(run_id="bad_run"))
    failure = spark.read.parquet(f"{sink}/failures").first()
    assert failure.error_type == "ValueError" and failure.execution_seconds >= 0 and failure.failed_at_utc is not None


def test_failure_record_is_whole(spark, monkeypatch):
    sink = os.path.join(_scratch(), "long-failure")
    message = "x" * 50_000 + "end"

    def fail(*_):
        raise RuntimeError(message)

    monkeypatch.setattr(J, "bronze_stage", fail)
    with pytest.raises(RuntimeError):
        J.run(spark, spark.range(1), sink, J.RunParams(run_id="long"))
    failure = spark.read.parquet(f"{sink}/failures").first()
    assert failure.error_message == message and failure.traceback.rstrip().endswith("end")


def test_a_failed_check_fails_its_table(spark):
    checks = [c for own in J.TABLE_CHECKS.values() for c in own]
    rows = [(c, "FAIL" if c == "daily_fraud" else "PASS") for c in checks]
    statuses = J.table_statuses(spark.createDataFrame(rows, "check_name string, status string"))
    assert [t for t, s in statuses.items() if s == "FAIL"] == ["daily_transaction_summary"]
    assert "FAIL" in J.table_statuses(spark.createDataFrame(rows[:1], "check_name string, status string")).values()  # a check that is missing
    tables = {t: spark.range(2) for t in ["daily_transaction_summary", "fraud_monitoring"]}
    audit = RC.audit_from_counts(RC.table_row_counts(tables), tables, dict.fromkeys(tables, "gold"), "r", statuses, {"fraud_monitoring": 1.5})
    got = {r.table_name: (r.reconciliation_status, r.execution_time_seconds) for r in audit.collect()}
    assert got == {"daily_transaction_summary": ("FAIL", 0.0), "fraud_monitoring": ("PASS", 1.5)}


def test_records_of_a_run_id_are_replaced(spark):
    path = os.path.join(_scratch(), "records")
    for run, n in (("a", 2), ("b", 3), ("a", 2)):
        K.append_records(spark.range(n).withColumn("pipeline_run_id", F.lit(run)), path)
    assert {r.pipeline_run_id: r["count"] for r in spark.read.parquet(path).groupBy("pipeline_run_id").count().collect()} == {"a": 2, "b": 3}


def test_ruled_run(spark):
    sink = os.path.join(_scratch(), "ruled")
    out = J.run_ruled(spark, C.raw(spark, SF_SMALL), sink, J.RunParams(run_id="ruled"))
    assert (out["silver_record_count"], out["quarantine_record_count"]) == (936, 66)
    assert out["reconciliation_status"] == "PASS" and out["run_started_at_utc"] <= out["run_completed_at_utc"]
    assert spark.read.parquet(f"{sink}/summary_ruled").first().gold_tables_written == 9
    audits = {n: spark.read.parquet(f"{sink}/audit_ruled/{n}").first().asDict() for n in ("raw_to_bronze", "bronze_to_silver", "silver_to_gold")}
    assert all(a["pipeline_status"] == "SUCCESS" and a["duration_seconds"] > 0 for a in audits.values())
    assert audits["raw_to_bronze"]["duplicate_record_count"] == 2
    gold = audits["silver_to_gold"]
    for name in J.RULED_MEASURES:
        assert gold[f"{name}_row_count"] == spark.read.parquet(f"{sink}/gold_ruled/{name}").count(), name
    hard = spark.read.option("header", True).option("inferSchema", True).csv(f"{sink}/quality_ruled/hard_failure_counts.csv")
    want = {r.rule_code: r.failed_records for r in C.REGISTRY["hard_rule_counts"](spark, SF_SMALL).collect()}
    assert {r.rule_code: r.failed_records for r in hard.collect()} == want
    statuses = spark.read.option("header", True).csv(f"{sink}/quality_ruled/validation_status_counts.csv")
    assert sum(int(r.record_count) for r in statuses.collect()) == 1002


def test_runs_over_no_rows(spark):
    empty = spark.createDataFrame([], NULLABLE_RAW_SCHEMA)
    sink = os.path.join(_scratch(), "empty")
    assert J.run(spark, empty, sink, J.RunParams(run_id="none"))["pipeline_status"] == "SUCCESS"
    assert J.run_ruled(spark, empty, sink, J.RunParams(run_id="none"))["reconciliation_status"] == "PASS"
    report = spark.read.parquet(f"{sink}/reconciliation/run_id=none")
    assert report.count() == 16 and report.filter("expected_value <> 0 OR status <> 'PASS'").count() == 0


def test_ruled_run_records_failures(spark):
    sink = os.path.join(_scratch(), "ruled-fail")
    with pytest.raises(Exception):
        J.run_ruled(spark, spark.range(3), sink, J.RunParams(run_id="bad"))
    assert spark.read.parquet(f"{sink}/failures").first().pipeline_run_id == "bad"


def test_unit_schema_is_nullable():
    assert all(f.nullable for f in NULLABLE_RAW_SCHEMA.fields)


def test_output_checks_and_latest_status(spark):
    sink = os.path.join(_scratch(), "checks")
    J.run(spark, C.raw(spark, SF_SMALL), sink, J.RunParams(run_id=J.new_run_id()))
    assert all(J.validate_outputs(spark, sink).values())
    assert J.latest_run_status(spark, sink)["healthy"]
    assert not J.validate_outputs(spark, sink, ["nope"])["nope"]


def test_quality_report_exports(spark):
    sink = os.path.join(_scratch(), "quality")
    paths = J.write_quality_reports(C.raw(spark, SF_SMALL), sink)
    assert len(paths) == 6
    report = spark.read.option("header", True).csv(paths[0])
    assert report.count() == 40


def test_descriptive_registry(spark):
    assert J.describe_gold_tables(spark).count() == 9


def test_audit_and_registry_from_counts_match_direct_forms(spark):
    tables = {"a": spark.range(3), "b": spark.range(5).withColumn("x", F.lit(1))}
    counts = RC.table_row_counts(tables)
    audit = RC.audit_from_counts(counts, tables, {"a": "gold", "b": "gold"}, "r").drop("audit_timestamp_utc", "execution_time_seconds")
    direct = RC.combine_audit_records([RC.audit_record(df, "r", "gold", n, with_time=False) for n, df in tables.items()])
    assert audit.exceptAll(direct).count() == 0 and direct.exceptAll(audit).count() == 0
    reg = RC.registry_from_counts(counts, tables, "r", "PARQUET")
    ref = RC.gold_registry(tables, "r", {"a": "PARQUET", "b": "PARQUET"})
    assert reg.exceptAll(ref.select(*reg.columns)).count() == 0
