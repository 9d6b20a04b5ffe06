"""Profiles at scale: counting instead of ranking or expanding, and certificates of estimates."""

import inspect
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlake.functions import sketch_bits, sketch_median
from ledgerlake.operators import marts as M
from ledgerlake.operators import quality as Q
from ledgerlake.operators import quantiles as QU
from ledgerlake.plans import catalog as C


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.optimizedPlan().toString() + qe.executedPlan().toString()


@pytest.mark.parametrize("name", ["column_cardinality", "cardinality_profile", "exact_accounts_by_day", "origin_account_profile",
                                  "daily_transaction_summary_exact", "hourly_fraud_profile", "numeric_profile", "nonbinary_values"])
def test_no_row_is_expanded(spark, name):
    assert "Expand" not in _plan(C.REGISTRY[name](spark, SF_SMALL))


def test_the_calendar_marts_scan_silver_once(spark, tmp_path):
    path = str(tmp_path / "silver")
    C.silver(spark, SF_SMALL).write.parquet(path)
    days = M.calendar_marts(M.calendar_rollup(spark.read.parquet(path)))["daily_transaction_summary"]
    assert days._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_quantiles_rank_no_row():
    source = inspect.getsource(QU)
    assert "prior_history" not in source and "row_number" not in source


def test_quantiles_read_the_input_twice_at_most(spark, tmp_path):
    path = str(tmp_path / "raw")
    C.raw(spark, SF_SMALL).write.parquet(path)
    df = Q.describe(spark.read.parquet(path), ["amount", "step"])
    # The counts are written once (one scan); what is left reads the moments and those counts.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"InMemoryFileIndex(1 paths)[file:{path}") == 1


def _linear(values, p):
    values = sorted(v for v in values if v is not None)
    pos = p * (len(values) - 1)
    lo, hi = values[math.floor(pos)], values[math.ceil(pos)]
    return lo + (pos - math.floor(pos)) * (hi - lo)


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_quantiles_of_hot_and_odd_groups(spark, parts):
    rng = np.random.default_rng(parts)
    rows = [("hot", float(v)) for v in rng.integers(0, 400, 3000)] + [(None, float(v)) for v in rng.standard_normal(50)]
    rows += [("one", 7.5), ("two", 1.0), ("two", 2.0), ("null", None), ("ties", 3.0), ("ties", 3.0), ("ties", 3.0), ("hot", None), ("zero", -0.0), ("zero", 0.0)]
    probs = [0.0, 0.01, 0.25, 0.5, 0.999, 1.0]
    got = QU.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "v", probs, ["g"], num_partitions=parts).collect()
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert len(got) == len(groups) * len(probs)
    for r in got:
        assert r["quantile"] == pytest.approx(_linear(groups[r["g"]], r["p"]), abs=1e-12)


def test_quantiles_without_groups_and_rows(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 100),) for i in range(1000)], "v double")
    monkeypatch.setattr(QU, "LISTED_RANGES", 0)  # the join alone selects the ranges
    got = {r["p"]: r["quantile"] for r in QU.exact_quantiles(df, "v", [0.5, 0.9], num_partitions=5).collect()}
    assert got == pytest.approx({0.5: 49.5, 0.9: 89.1})
    assert QU.exact_quantiles(df.limit(0), "v", [0.5]).collect() == []


def test_rank_errors_tell_good_from_bad(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 1001)] + [(None,)], "v double")
    errors = {r["p"]: r["rank_error"] for r in QU.rank_errors(df, "v", {0.5: 500.0, 0.25: 400.0, 0.9: 900.5, 0.1: None}).collect()}
    assert errors[0.5] == 0 and errors[0.9] == 0 and errors[0.25] == pytest.approx(0.149) and 0.1 not in errors
    assert QU.rank_errors(df, "v", {0.5: None}).collect() == []


def test_distinct_errors_tell_good_from_bad(spark):
    silver = spark.createDataFrame([(d, f"o{i}", f"d{i % 7}") for d in (1, 2) for i in range(50)], "transaction_day int, origin_account string, destination_account string")
    given = spark.createDataFrame([(1, 51, 7), (2, 90, 7)], "transaction_day int, estimated_unique_origin_accounts long, estimated_unique_destination_accounts long")
    got = {r["transaction_day"]: r for r in M.distinct_errors(given, silver, ["transaction_day"]).collect()}
    assert got[1]["origin_estimate_within_bound"] and not got[2]["origin_estimate_within_bound"]
    assert got[1]["unique_origin_accounts"] == 50 and got[1]["unique_destination_accounts"] == 7 and got[2]["destination_estimate_within_bound"]


def test_merged_sketches_stay_within_their_error(spark):
    rows = spark.range(200_000).select((F.col("id") % 4).alias("day"), (F.col("id") % 96).alias("step"), F.concat(F.lit("C"), F.col("id") % 50_000).alias("a"))
    for rsd in (0.02, 0.05, 0.2):
        cells = rows.groupBy("day", "step").agg(F.hll_sketch_agg("a", F.lit(sketch_bits(rsd))).alias("s"))
        exact = {r["day"]: r["n"] for r in rows.groupBy("day").agg(F.count_distinct("a").alias("n")).collect()}
        for r in cells.groupBy("day").agg(F.hll_sketch_estimate(F.hll_union_agg("s")).alias("n")).collect():
            assert abs(r["n"] - exact[r["day"]]) <= 4 * rsd * exact[r["day"]]


def test_sketched_median_rank(spark):
    df = spark.range(300_000).select((F.hash("id") % 100_003).cast("double").alias("amount"), (F.col("id") % 3).alias("g"))
    for r in df.groupBy("g").agg(sketch_median().alias("m")).collect():
        below = df.filter((F.col("g") == r["g"]) & (F.col("amount") <= r["m"])).count()
        assert abs(below / 100_000 - 0.5) < 0.001
    assert df.limit(0).agg(sketch_median().alias("m")).first()["m"] is None


def test_rows_per_partition_with_empty_ones(spark):
    df = spark.range(10).repartition(4).withColumn("p", F.spark_partition_id()).filter("p < 2").drop("p")
    rows = Q.rows_per_partition(df).collect()
    assert sorted(r["partition_id"] for r in rows) == [0, 1, 2, 3]
    assert sum(r["row_count"] for r in rows) == df.count() and sum(r["row_count"] == 0 for r in rows) >= 2
    s = Q.partition_skew(df).first()
    assert s["partitions"] == 4 and s["non_empty_partitions"] <= 2 and s["min_rows"] == 0 and s["total_rows"] == df.count()


def test_distinct_values_of_odd_columns(spark):
    df = spark.createDataFrame([(1, None, 0.0), (1, "", -0.0), (2, "x", float("nan")), (None, "x", float("nan"))], "a int, `b.c` string, d double")
    got = {r["column_name"]: (r["unique_count"], r["null_count"], r["row_count"]) for r in Q.distinct_values(df, df.columns).collect()}
    assert got == {"a": (2, 1, 4), "b.c": (2, 1, 4), "d": (2, 0, 4)}
    empty = Q.cardinality_profile(df.limit(0)).collect()
    assert [(r["unique_count"], r["cardinality_pct"]) for r in empty] == [(0, 0.0)] * 3
