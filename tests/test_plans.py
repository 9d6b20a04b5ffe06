"""Plan-shape guards: no cross / nested-loop joins, filters reach the Parquet scan."""

import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerlake.contracts import BRONZE_REQUIRED_COLUMNS
from ledgerlake.functions import record_hash
from ledgerlake.operators import bronze as B
from ledgerlake.operators import features as FE
from ledgerlake.operators import marts as M
from ledgerlake.operators import silver as S
from ledgerlake.plans import catalog as C
from ledgerlake.plans import job as J

WRITES_DATA = {"scan_csv_strict", "scan_csv_permissive", "csv_export_roundtrip", "export_roundtrip",
               "parquet_partitioned_roundtrip"}


def _plans(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.optimizedPlan().toString() + qe.executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - WRITES_DATA))
def test_no_cross_or_nested_loop_join(spark, name):
    plan = _plans(E.queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_filters_and_pruning_reach_the_silver_scan(spark):
    sink = tempfile.mkdtemp(prefix="ledgerlake-plan-")
    params = J.RunParams(run_id="plan")
    bronze = J.bronze_stage(spark, C.raw(spark, SF_SMALL), sink, params)
    silver = J.silver_stage(spark, bronze, sink, params)
    plan = M.fraud_monitoring(silver)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(is_fraud), EqualTo(is_fraud,1)]" in plan
    assert "origin_old_balance" not in plan  # unused columns are pruned from the scan


def test_calendar_rollups_expand_cells_and_not_the_fact_table(spark):
    silver, ruled = C.silver(spark, SF_SMALL), C.silver_ruled(spark, SF_SMALL)
    # what lies below an Expand is the aggregate of the cells
    for rollup in (M.calendar_rollup(silver), M.ruled_calendar_rollup(ruled)):
        lines = rollup._jdf.queryExecution().optimizedPlan().toString().splitlines()
        below = [lines[k + 1] for k, line in enumerate(lines) if "Expand" in line]
        assert len(below) == 1 and "Aggregate" in below[0]
    assert "Expand" not in _plans(M.ruled_distinct_accounts(ruled))


def _transactions(spark, n=400):
    """Bronze rows of few accounts and two days, so that many share their account and step; some are not valid."""
    rows = [(i % 48 if i % 9 else None, "TRANSFER" if i % 7 else "BOGUS", float(i * 37 % 101) + 0.25, f"C{i % 3}", 500.0, 400.5,
             f"M{i % 5}", 0.0, float(i % 11), int(i % 13 == 0), 0) for i in range(n)]
    schema = ("step int, type string, amount double, nameOrig string, oldbalanceOrg double, newbalanceOrig double, "
              "nameDest string, oldbalanceDest double, newbalanceDest double, isFraud int, isFlaggedFraud int")
    return B.bronze_transactions(spark.createDataFrame(rows, schema))


def _same_rows(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_silver_moves_bronze_rows_and_makes_features_behind_the_shuffle(spark, monkeypatch):
    sink = tempfile.mkdtemp(prefix="ledgerlake-plan-")
    written = {}

    def kept(df, path, **how):
        files = how.get("files")
        written["df"] = J.spread(df, "transaction_day", files) if files else df
        return write(df, path, **how)

    write = J.write_parquet
    monkeypatch.setattr(J, "write_parquet", kept)
    monkeypatch.setattr(J, "files_per_value", lambda df, column: {None: 1, 0: 1, 1: 2, 2: 1})
    bronze = _transactions(spark)
    silver = J.silver_stage(spark, bronze, sink, J.RunParams(run_id="plan"))
    made, moved, below = written["df"]._jdf.queryExecution().optimizedPlan().toString().partition("RepartitionByExpression")
    assert moved and "origin_balance_error" in made and "origin_balance_error" not in below
    expected = S.silver_transactions(bronze)
    assert _same_rows(S.without_timestamps(silver.select(*expected.columns)), S.without_timestamps(expected))
    assert silver.count() > 200


def test_strict_history_orders_by_the_bytes_of_the_hash(spark, monkeypatch):
    given = {}
    history = FE.prior_history_window
    silver = S.silver_transactions(_transactions(spark))
    monkeypatch.setattr(FE, "prior_history", lambda df, key, order, key_counts=None: given.update(df=df) or history(df, key, order))
    features = FE.fraud_feature(silver)
    assert dict(given["df"].dtypes)["_record_hash"] == "binary"  # 32 bytes a row to shuffle, not 64
    as_text = silver.withColumn("_record_hash", record_hash(BRONZE_REQUIRED_COLUMNS))
    expected = history(as_text, "origin_account", ["step", "_record_hash"]).select(
        "origin_account", "step", "amount", F.col("_prior_count").alias("prior_origin_transaction_count"),
        F.round(F.col("_prior_max"), 2).alias("prior_origin_maximum_amount"))
    assert _same_rows(features.select(*expected.columns), expected)


def test_passes_over_silver_run_side_by_side(spark, monkeypatch):
    sink = tempfile.mkdtemp(prefix="ledgerlake-plan-")
    together, write = [], J.write_many
    monkeypatch.setattr(J, "write_many", lambda tables, *a, **b: together.append(list(tables)) or write(tables, *a, **b))
    log = J.RunLog()
    silver = S.silver_transactions(_transactions(spark))
    tables = J.write_gold(spark, silver, sink, log=log)
    assert together[0] == ["_calendar_rollup", "origin_account_summary", "destination_account_summary", "fraud_monitoring"]
    assert together[1][0] == "fraud_feature" and len(together[1]) == 6
    assert set(tables) == set(log.tables) == set(J.MART_MEASURES) and log.values["origin_rows"] == silver.count()
