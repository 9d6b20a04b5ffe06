"""Benchmark the pipeline at one scale factor; prints ONE JSON line.

``value`` covers the same scope as the reference's published end-to-end run
exports, the fraud rows, and reconciliation + audit + registry + run summary.
Stages beyond that scope (account summaries, fraud features, the ruled
profile, the quality report) are timed too and summed in ``all_stages_sec``.
Session start-up is reported separately and excluded from both.

``baseline_size`` repeats the run at the baseline's number of rows, in the same session: the events
again and again, ids and accounts offset, as CSV files that Bronze parses in full. Writing those files
isn't timed.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_ROWS (rows of
the second run, default 6362620; 0 leaves it out).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

BASELINE_SCOPE = ["bronze", "silver", "calendar_marts", "fraud_monitoring", "reconciliation_audit"]


def run_stages(spark, source, sink: str, ruled: bool = True) -> tuple[dict[str, float], dict[str, int]]:
    """Seconds of each stage of the job, and rows; the ruled profile and the quality report if asked for."""
    from pyspark.sql import functions as F

    from ledgerlake.operators import bronze as B
    from ledgerlake.operators import features as FE
    from ledgerlake.operators import marts as M
    from ledgerlake.operators import quality as Q
    from ledgerlake.plans import job as J
    from ledgerlake.sources.sinks import export_csv_file, write_many, write_parquet

    params, log = J.RunParams(run_id="bench_run"), J.RunLog()
    times: dict[str, float] = {}

    def timed(name, fn):
        start = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - start, 3)
        return out

    bronze = timed("bronze", lambda: J.bronze_stage(spark, source, sink, params, log))
    silver = timed("silver", lambda: J.silver_stage(spark, bronze, sink, params, log))
    rows = {"bronze_row_count": log.values["bronze_rows"], "silver_row_count": log.values["silver_rows"], "silver_fraud_count": log.values["silver_fraud"]}

    def write(tables):
        for name, written in write_many(tables, f"{sink}/gold", measures=J.mart_measures(tables)).items():
            log.add(name, written)

    def calendar():
        rollup_path = f"{sink}/gold/_calendar_rollup"
        write_parquet(M.calendar_rollup(silver), rollup_path)
        write(M.calendar_marts(spark.read.parquet(rollup_path)))
        for name, keys in J.SMALL_MARTS.items():
            log.exports.append(export_csv_file(spark.read.parquet(f"{sink}/gold/{name}"), f"{sink}/exports", f"{name}.csv", sort_by=keys))

    def fraud_rows():
        write({"fraud_monitoring": M.fraud_monitoring(silver)})
        J.export_fraud_rows(spark, spark.read.parquet(f"{sink}/gold/fraud_monitoring"), f"{sink}/exports", log.tables["fraud_monitoring"].rows, log)

    timed("calendar_marts", calendar)
    timed("fraud_monitoring", fraud_rows)
    timed("account_summaries", lambda: write(
        {"origin_account_summary": M.origin_account_summary(silver),
         "destination_account_summary": M.destination_account_summary(silver)}))
    origin = spark.read.parquet(f"{sink}/gold/origin_account_summary")
    timed("fraud_feature", lambda: write({"fraud_feature": FE.fraud_feature(silver, origin_counts=origin)}))
    rows["pipeline_status_success"] = int(timed("reconciliation_audit", lambda: J.finalize_run(spark, sink, params, log)["pipeline_status"]) == "SUCCESS")
    if not ruled:
        return times, rows

    raw_from_bronze = B.to_raw_names(bronze)
    ruled_bronze = B.bronze_ruled(raw_from_bronze, params.run_id, params.source_file_name)
    validated = timed("ruled_validate", lambda: J.write_validated(spark, ruled_bronze, sink, params))
    silver_ruled = J.silver_ruled_view(validated)
    timed("ruled_marts", lambda: J.write_ruled_gold(spark, silver_ruled, sink))
    report = timed("quality_report", lambda: Q.quality_report(raw_from_bronze).collect())
    rows["quality_checks"] = len(report)
    rows["quarantine_rows"] = validated.filter(F.col("validation_status") == "QUARANTINE").count()
    return times, rows


def in_scope(times: dict[str, float]) -> float:
    return round(sum(times[k] for k in BASELINE_SCOPE), 3)


def baseline_size(spark, sf_dir: str, sink: str, wanted: int, cpus: int) -> dict:
    """The strict run over about ``wanted`` rows."""
    from pyspark.sql import functions as F

    from ledgerlake.sources.fixture import raw_from_events, read_events
    from ledgerlake.sources.sinks import write_csv

    events = read_events(spark, sf_dir)
    repeat = max(1, -(-wanted // max(1, events.count())))
    again = events.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))))
    moved = again.withColumns({"event_id": F.col("event_id") + F.col("k") * 1_000_003, "user_id": F.col("user_id") + F.col("k") * 1_000}).drop("k")
    write_csv(raw_from_events(moved.repartition(4 * cpus)), f"{sink}/source")
    times, rows = run_stages(spark, f"{sink}/source", f"{sink}/run", ruled=False)
    return {"pipeline_sec": in_scope(times), "rows_per_sec": round(rows["bronze_row_count"] / in_scope(times), 1), "queries": times, "rows": rows}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = int(os.environ.get("BENCH_ROWS", "6362620"))

    from ledgerlake.session import checkpoint_root, local_session
    from ledgerlake.sources.fixture import raw_transactions

    t0 = time.perf_counter()
    spark = local_session(cpus=cpus, shuffle_partitions=cpus, app="ledgerlake-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).count()
    session_start = time.perf_counter() - t0
    checkpoint_root(spark)

    times, rows = run_stages(spark, raw_transactions(spark, sf_dir), tempfile.mkdtemp(prefix="ledgerlake-bench-"))
    value = in_scope(times)
    out = {
        "metric": "pipeline_sec",
        "value": value,
        "unit": "sec",
        "scope": "bronze + silver + 5 calendar marts (+CSV) + fraud rows (+CSV) + reconciliation/audit/registry/summary",
        "queries": times,
        "all_stages_sec": round(sum(times.values()), 3),
        "rows_per_sec": round(rows["bronze_row_count"] / value, 1) if value else None,
        "rows": rows,
        "session_start_sec": round(session_start, 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    if wanted:
        out["baseline_size"] = baseline_size(spark, sf_dir, tempfile.mkdtemp(prefix="ledgerlake-bench-"), wanted, cpus)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
