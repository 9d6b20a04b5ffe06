import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fixtures import unit_raw
from ledgerlake.contracts import assert_no_balance_leakage
from ledgerlake.operators import bronze as B
from ledgerlake.operators import features as FE
from ledgerlake.operators import marts as M
from ledgerlake.operators import silver as S
from ledgerlake.operators.history import prior_history, prior_history_scan, prior_history_window
from ledgerlake.plans import catalog as C


@pytest.fixture(scope="module")
def unit_silver(spark):
    return S.silver_transactions(B.bronze_transactions(unit_raw(spark))).cache()


def test_daily_summary(unit_silver):
    rows = M.daily_transaction_summary(unit_silver).collect()
    assert sorted(r.transaction_day for r in rows) == [1, 2]
    assert sum(r.transaction_count for r in rows) == 4
    assert sum(r.fraud_count for r in rows) == 2
    day1 = next(r for r in rows if r.transaction_day == 1)
    assert day1.fraud_amount == 300000.0 and day1.total_transaction_amount == 300100.0


def test_daily_join_form_equals_single_pass(unit_silver):
    a = M.daily_transaction_summary(unit_silver)
    b = M.daily_transaction_summary_join(unit_silver)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_type_and_high_value_summaries(unit_silver):
    assert M.transaction_type_summary(unit_silver).count() == 4
    hv = M.high_value_summary(unit_silver).collect()
    assert len(hv) == 1 and hv[0].high_value_total_amount == 300000.0 and hv[0].high_value_fraud_count == 1


def test_fraud_rows(unit_silver):
    assert M.fraud_monitoring(unit_silver).count() == 2


def test_prior_history_feature(unit_silver):
    feat = FE.fraud_feature(unit_silver).filter((F.col("origin_account") == "C002") & (F.col("step") == 25)).first()
    assert feat.prior_origin_transaction_count == 1
    assert feat.prior_origin_average_amount == 300000.0
    first = FE.fraud_feature(unit_silver).filter(F.col("step") == 2).first()
    assert first.prior_origin_transaction_count == 0 and first.prior_origin_average_amount is None


def test_gold_registry_has_nine_tables(unit_silver):
    assert len(M.build_gold_tables(unit_silver)) == 9


def test_rsd_bounds(unit_silver):
    with pytest.raises(ValueError):
        M.daily_transaction_summary(unit_silver, approximate_distinct_rsd=0.4)


def test_approximate_distinct_error_is_bounded(spark):
    s = C.silver(spark, SF_SMALL)
    est = M.daily_transaction_summary(s).select("transaction_day", "estimated_unique_origin_accounts")
    exact = s.groupBy("transaction_day").agg(F.count_distinct("origin_account").alias("n"))
    for r in est.join(exact, "transaction_day").collect():
        assert abs(r.estimated_unique_origin_accounts - r.n) <= max(1, 3 * 0.05 * r.n)


def test_calendar_rollup_equals_single_marts(spark):
    s = C.silver(spark, SF_SMALL)
    split = M.calendar_marts(M.calendar_rollup(s))
    single = {
        "daily_transaction_summary": M.daily_transaction_summary(s),
        "daily_type_summary": M.daily_type_summary(s),
        "hourly_fraud_summary": M.hourly_fraud_summary(s),
        "transaction_type_summary": M.transaction_type_summary(s),
        "high_value_summary": M.high_value_summary(s),
    }
    estimates = ["estimated_unique_origin_accounts", "estimated_unique_destination_accounts"]  # of another kind of sketch
    for name, df in single.items():
        df = df.drop(*estimates)
        got = split[name].select(*df.columns)
        assert got.exceptAll(df).count() == 0 and df.exceptAll(got).count() == 0, name
    bounds = M.distinct_errors(split["daily_transaction_summary"], s, ["transaction_day"]).collect()
    assert all(r.origin_estimate_within_bound and r.destination_estimate_within_bound for r in bounds) and len(bounds) == 31


def _history_input(spark):
    from ledgerlake.contracts import BRONZE_REQUIRED_COLUMNS
    from ledgerlake.functions import record_hash

    return C.silver(spark, SF_SMALL).select(
        "origin_account", "step", "amount", "is_fraud", record_hash(BRONZE_REQUIRED_COLUMNS).alias("_record_hash")
    )


def test_prefix_scan_equals_window(spark):
    df = _history_input(spark)
    order = ["step", "_record_hash"]
    ref = prior_history_window(df, "origin_account", order)
    for n_parts in (3, 8):
        got = prior_history_scan(df, "origin_account", order, num_partitions=n_parts).select(*ref.columns)
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_hot_key_split_equals_window(spark):
    df = _history_input(spark)
    order = ["step", "_record_hash"]
    ref = prior_history_window(df, "origin_account", order)
    got = prior_history(df, "origin_account", order, hot_key_rows=20).select(*ref.columns)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_single_hot_key_spans_partitions(spark):
    """Every row on one account: the scan spreads it over all range partitions."""
    df = _history_input(spark).withColumn("origin_account", F.lit("C1"))
    order = ["step", "_record_hash"]
    ref = prior_history_window(df, "origin_account", order)
    got = prior_history_scan(df, "origin_account", order, num_partitions=6)
    assert got.select(*ref.columns).exceptAll(ref).count() == 0
    assert got.agg(F.max("_prior_count")).first()[0] == df.count() - 1


def test_feature_tables_exclude_balances(spark):
    feats = FE.fraud_feature_profile(C.silver_ruled(spark, SF_SMALL))
    assert_no_balance_leakage(feats)
    with pytest.raises(ValueError):
        assert_no_balance_leakage(C.silver_ruled(spark, SF_SMALL))


def test_features_preserve_rows(spark):
    s = C.silver(spark, SF_SMALL)
    assert FE.fraud_feature(s).count() == s.count()


def test_group_of_copies_is_split_by_the_scan(spark):
    """One row copied 400 times (plus the rest): identical order keys still spread over partitions."""
    base = _history_input(spark)
    hot_row = base.orderBy("origin_account", "step", "_record_hash").limit(1)
    copies = hot_row.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(400)))).drop("_n")
    df = base.unionByName(copies)
    order = ["step", "_record_hash"]
    ref = prior_history_window(df, "origin_account", order)
    got = prior_history_scan(df, "origin_account", order, num_partitions=5).select(*ref.columns)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    per_part = got.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert per_part < df.count()  # no single task holds the copies


def test_ruled_rollup_equals_single_marts(spark):
    s = C.silver_ruled(spark, SF_SMALL)
    split = M.ruled_calendar_marts(M.ruled_calendar_rollup(s), M.ruled_distinct_accounts(s), M.ruled_type_medians(s))
    single = {
        "daily_transaction_summary": M.daily_transaction_summary_exact(s),
        "hourly_fraud_summary": M.hourly_fraud_profile(s),
        "transaction_type_summary": M.transaction_type_profile(s),
        "high_value_summary": M.high_value_profile(s),
        "daily_type_summary": M.daily_type_profile(s),
    }
    for name, df in single.items():
        got = split[name].select(*df.columns)
        assert got.exceptAll(df).count() == 0 and df.exceptAll(got).count() == 0, name


def _odd_history(spark, key_type):
    """Cents, NULL amounts, NULL keys, ties: the same account history under keys of two types."""
    rows = []
    for i in range(900):
        key = None if i % 7 == 0 else i % 3
        rows.append((key, i % 40, None if i % 50 == 0 else round(i * 0.1 + 0.01, 2), i % 2, f"h{i // 2}"))
    df = spark.createDataFrame(rows, "k int, step int, amount double, is_fraud int, _record_hash string")
    return df.withColumn("k", F.col("k").cast(key_type))


@pytest.mark.parametrize("key_type", ["int", "string"])
def test_scan_equals_window_on_cents_nulls_and_any_key(spark, key_type):
    # rows that tie on the whole order but differ in amount have no order: take them apart by hash
    df = _odd_history(spark, key_type).withColumn("_record_hash", F.concat("_record_hash", F.lit("_"), F.coalesce(F.col("amount").cast("string"), F.lit("-"))))
    order = ["step", "_record_hash"]
    ref = prior_history_window(df, "k", order)
    scans = [prior_history_scan(df, "k", order, num_partitions=5), prior_history(df, "k", order, hot_key_rows=150), prior_history(df, "k", order, hot_key_rows=10)]
    for got in scans:
        got = got.select(*ref.columns)
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_results_come_in_the_stated_order(spark):
    def rows(name, *cols):
        return [tuple(r[c] for c in cols) for r in C.REGISTRY[name](spark, SF_SMALL).collect()]

    def descending(got):
        assert len(got) > 1 and got == sorted(got, key=lambda r: (-r[0], r[1]))

    known = [r for r in rows("sql_type_summary", "fraud_rate_pct", "transaction_type") if r[0] is not None]
    assert [r[0] for r in known] == sorted((r[0] for r in known), reverse=True)
    steps = [r[0] for r in rows("sql_hourly_summary", "step") if r[0] is not None]
    assert steps == sorted(steps)
    descending(rows("sql_silver_type_summary", "transaction_count", "transaction_type"))
    descending(rows("sql_gold_type_lookup", "transaction_count", "transaction_type"))
    descending(rows("sql_status_summary", "record_count", "validation_status"))
    descending([r for r in rows("amount_category_counts", "transaction_count", "amount_category") if r[1]])
    descending([r for r in rows("destination_category_counts", "transaction_count", "destination_category") if r[1]])
    descending([r for r in rows("fraud_only_by_type", "fraud_count", "type") if r[1]])
    descending(rows("fraud_by_type", "fraud_rate_pct", "type"))
