import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlake.contracts import find_missing_columns, schema_drift, validate_required_columns
from ledgerlake.operators import quality as Q
from ledgerlake.operators import reconcile as RC
from ledgerlake.plans import catalog as C


def test_find_missing_columns_keeps_required_order(spark):
    df = spark.createDataFrame([(1, "PAYMENT")], "step int, transaction_type string")
    assert find_missing_columns(df, ["amount", "step", "is_fraud"]) == ["amount", "is_fraud"]


def test_validate_required_columns_message(spark):
    df = spark.createDataFrame([(1,)], "step int")
    with pytest.raises(ValueError, match=r"frame is missing required columns: \['amount'\]"):
        validate_required_columns(df, ["step", "amount"], "frame")


def test_schema_drift():
    d = schema_drift(["b", "a", "x"], ["a", "b", "c"])
    assert d == {"missing_columns": ["c"], "unexpected_columns": ["x"], "column_order_matches": False}


def test_null_profile_counts_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "number int, letter string")
    row = Q.null_profile(df).first()
    assert (row.number, row.letter) == (1, 1)
    empty = Q.null_profile(df.limit(0)).first()
    assert (empty.number, empty.letter) == (0, 0)


def test_duplicate_key_groups_and_rows(spark):
    df = spark.createDataFrame([(1, "C1"), (1, "C1"), (1, "C1"), (2, "C2")], "step int, account string")
    row = Q.duplicate_keys(df, ["step", "account"]).first()
    assert (row.duplicate_groups, row.duplicate_rows) == (1, 2)


def test_nonbinary_values(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "indicator int")
    assert [r.value for r in Q.nonbinary_values(df, ["indicator"]).collect()] == [2]


def test_count_reconciliation(spark):
    a = spark.range(5)
    b = spark.range(3)
    passed = RC.count_reconciliation(a, a).first()
    failed = RC.count_reconciliation(a, b).first()
    assert passed.reconciliation_status == "PASS" and passed.row_count_difference == 0
    assert failed.reconciliation_status == "FAIL" and failed.row_count_difference == -2


def test_quality_report_has_forty_checks(spark):
    report = Q.quality_report(C.raw(spark, SF_SMALL))
    rows = report.collect()
    assert len(rows) == 40
    by_name = {r.check_name: r for r in rows}
    assert by_name["expected_columns_present"].status == "PASS"
    assert by_name["no_exact_duplicate_rows"].failed_records == 2
    assert by_name["valid_transaction_type"].status == "FAIL"
    assert all(r.records_tested >= r.failed_records for r in rows)


def test_missing_steps_anti_join(spark):
    missing = [r.step for r in Q.missing_steps(C.raw(spark, SF_SMALL)).collect()]
    assert all(1 <= s <= 744 for s in missing) and 744 in missing


def test_exact_quantiles_match_pandas(spark):
    import numpy as np

    from ledgerlake.operators.quantiles import exact_quantiles

    s = C.silver(spark, SF_SMALL)
    got = {(r.transaction_type, r.p): r.quantile
           for r in exact_quantiles(s, "amount", [0.1, 0.5, 0.9], ["transaction_type"]).collect()}
    pdf = s.select("transaction_type", "amount").toPandas()
    for (t, p), q in got.items():
        expected = float(np.quantile(pdf[pdf.transaction_type == t].amount.to_numpy(), p))
        assert abs(q - expected) <= 1e-6 * max(1.0, abs(expected))


def test_partition_reconciliation_is_exact(spark):
    row = RC.partition_reconciliation(C.validated(spark, SF_SMALL)).first()
    assert row.bronze_record_count == row.silver_record_count + row.quarantine_record_count
    assert row.reconciliation_status == "PASS"


def test_pipeline_status_success(spark):
    assert C.REGISTRY["pipeline_status"](spark, SF_SMALL).first().pipeline_status == "SUCCESS"


def test_silver_binary_metrics_zero(spark):
    row = Q.silver_binary_metrics(C.silver(spark, SF_SMALL)).first()
    assert tuple(row) == (0, 0, 0)


def test_rule_counts_sum(spark):
    from ledgerlake.operators import rules as R

    v = C.validated(spark, SF_SMALL)
    counts = R.rule_counts(v, R.hard_rules(), "HARD").agg(F.sum("failed_records")).first()[0]
    assert counts >= v.filter(F.col("hard_failure_count") > 0).count()


def test_schema_profile(spark):
    from ledgerlake.contracts import schema_profile

    df = spark.createDataFrame([(1, "a")], "step int, type string")
    assert schema_profile(df) == [("step", "int", True), ("type", "string", True)]


def test_sizing_conf_scales_with_input():
    from ledgerlake.session import sizing_conf

    small = sizing_conf(10 * 1024 ** 2, total_cores=8)
    huge = sizing_conf(100 * 1024 ** 4, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
    assert int(huge["spark.sql.shuffle.partitions"]) > 400_000


def test_exact_quantiles_through_the_prefix_scan(spark):
    """Force every group through the scan path (tiny hot threshold); values must not change."""
    import numpy as np

    from ledgerlake.operators.history import HOT_KEY_ROWS_CONF
    from ledgerlake.operators.quantiles import exact_quantiles

    s = C.silver(spark, SF_SMALL)
    spark.conf.set(HOT_KEY_ROWS_CONF, "10")
    try:
        got = {(r.transaction_type, r.p): r.quantile
               for r in exact_quantiles(s, "amount", [0.05, 0.5, 0.95], ["transaction_type"]).collect()}
    finally:
        spark.conf.unset(HOT_KEY_ROWS_CONF)
    pdf = s.select("transaction_type", "amount").toPandas()
    assert len(got) == 15
    for (t, p), q in got.items():
        expected = float(np.quantile(pdf[pdf.transaction_type == t].amount.to_numpy(), p))
        assert abs(q - expected) <= 1e-6 * max(1.0, abs(expected))
