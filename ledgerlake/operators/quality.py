"""Data-quality operators: profiles, duplicate / domain checks and the check report.

Row-level checks compile to one aggregation pass (``count_if`` per check and
per denominator); only exact duplicates and missing steps need their own
shuffle. Long (unpivoted) outputs come from ``unpivot`` over the one-row
aggregate, so nothing is collected to the driver. Distinct counts of several
columns explode narrow (column, value) pairs instead of expanding whole rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.contracts import (
    BALANCE_TOLERANCE,
    EXPECTED_FRAUD_TYPES,
    HIGH_VALUE_THRESHOLD,
    MAX_STEP,
    MIN_STEP,
    OUTGOING_TYPES,
    RAW_COLUMNS,
    VALID_TRANSACTION_TYPES,
    schema_drift,
)
from ledgerlake.functions import money_total
from ledgerlake.operators.quantiles import exact_quantiles, pivot_quantiles

BALANCE_COLUMNS = ["oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
NUMERIC_COLUMNS = ["amount", *BALANCE_COLUMNS]


# ------------------------------------------------------------------ profiles

def null_profile(df: DataFrame) -> DataFrame:
    """One row, the NULL count of every column (0 on empty input)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def null_profile_long(df: DataFrame) -> DataFrame:
    """column_name, null_count, null_pct (round 6) -- one pass, then unpivot."""
    wide = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = wide.unpivot(["_n"], df.columns, "column_name", "null_count")
    return long.select(
        "column_name", "null_count",
        F.when(F.col("_n") > 0, F.round(F.col("null_count") / F.col("_n") * 100.0, 6)).otherwise(F.lit(0.0)).alias("null_pct"),
    )


def duplicate_keys(df: DataFrame, key_columns: Sequence[str]) -> DataFrame:
    """Key groups seen more than once and the surplus rows they hold (one row)."""
    groups = df.groupBy(*key_columns).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    return groups.agg(
        F.count("*").alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
    )


def nonbinary_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values outside {0, 1}, per column (column_name, value); one scan of all columns."""
    pair = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("value"), F.col(c).isin(0, 1).alias("binary")) for c in columns]
    values = df.select(F.explode(F.array(*pair)).alias("x")).select("x.*")
    return values.filter(~F.col("binary")).select("column_name", "value").distinct()


def bronze_validation_metrics(raw: DataFrame) -> DataFrame:
    """Invalid counts with NULL counted as invalid (one pass)."""
    c = F.col

    def invalid(valid: Column) -> Column:
        return F.count_if(~F.coalesce(valid, F.lit(False)))

    return raw.agg(
        invalid(c("type").isin(*VALID_TRANSACTION_TYPES)).alias("invalid_transaction_type_count"),
        invalid(c("step").between(MIN_STEP, MAX_STEP)).alias("invalid_step_count"),
        invalid(c("amount") >= 0).alias("invalid_amount_count"),
        invalid(c("isFraud").isin(0, 1)).alias("invalid_fraud_flag_count"),
        invalid(c("isFlaggedFraud").isin(0, 1)).alias("invalid_flagged_fraud_count"),
    )


def numeric_validation(raw: DataFrame) -> DataFrame:
    """Validation counts where NULL is not counted."""
    c = F.col
    return raw.agg(
        F.count_if(c("amount") < 0).alias("negative_amount_count"),
        F.count_if(c("amount") == 0).alias("zero_amount_count"),
        F.count_if(~c("isFraud").isin(0, 1)).alias("invalid_fraud_flag_count"),
        F.count_if(~c("isFlaggedFraud").isin(0, 1)).alias("invalid_flagged_fraud_count"),
    )


def silver_binary_metrics(silver: DataFrame) -> DataFrame:
    c = F.col
    return silver.agg(
        F.count_if(~c("is_fraud").isin(0, 1)).alias("invalid_is_fraud_count"),
        F.count_if(~c("is_flagged_fraud").isin(0, 1)).alias("invalid_is_flagged_fraud_count"),
        F.count_if(~c("is_high_value_transaction").isin(0, 1)).alias("invalid_high_value_count"),
    )


def silver_metrics(silver: DataFrame) -> DataFrame:
    """The totals of a strict Silver table in one row; an empty table counts 0."""
    return silver.agg(
        F.count("*").alias("silver_row_count"),
        F.coalesce(F.sum("is_fraud"), F.lit(0)).cast("bigint").alias("silver_fraud_count"),
        F.coalesce(F.sum("is_flagged_fraud"), F.lit(0)).cast("bigint").alias("silver_flagged_fraud_count"),
        F.coalesce(F.sum("is_high_value_transaction"), F.lit(0)).cast("bigint").alias("silver_high_value_count"),
        money_total().alias("silver_total_amount"),
    )


def flag_detection_rate(raw: DataFrame) -> DataFrame:
    fraud = F.col("isFraud") == 1
    agg = raw.agg(
        F.count_if(fraud).alias("fraud_count"),
        F.count_if(fraud & (F.col("isFlaggedFraud") == 1)).alias("flagged_fraud_count"),
    )
    return agg.withColumn(
        "flag_detection_rate_pct",
        F.when(F.col("fraud_count") > 0, F.col("flagged_fraud_count") / F.col("fraud_count") * 100.0).otherwise(F.lit(0.0)),
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, unique_count (of values, NULL is none), null_count, row_count: all columns from one scan.

    Rows become narrow (column number, value as text) pairs, counted before they are shuffled;
    a second grouping counts the pairs per column. The text of a value is as distinct as the
    value. Keys are (column, value), so no column ends in one task.
    """
    spark = df.sparkSession
    pair = [F.struct(F.lit(i).alias("i"), _as_text(F.col(f"`{c}`"), df.schema[c].dataType.typeName()).alias("v")) for i, c in enumerate(columns)]
    values = df.select(F.explode(F.array(*pair)).alias("x")).groupBy("x.i", "x.v").agg(F.count("*").alias("n"))
    counted = values.groupBy("i").agg(
        F.count("v").alias("unique_count"), F.sum("n").alias("row_count"), F.sum(F.when(F.col("v").isNull(), F.col("n"))).alias("null_count")
    )
    names = spark.createDataFrame(list(enumerate(columns)), "i int, column_name string")  # an empty table has no pairs
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return names.join(counted, "i", "left").select("column_name", *[zero(c) for c in ("unique_count", "null_count", "row_count")])


def _as_text(value: Column, kind: str) -> Column:
    """Equal values as equal texts: -0.0 is 0.0."""
    return (value + F.lit(0.0)).cast("string") if kind in ("double", "float") else value.cast("string")


def cardinality_profile(df: DataFrame, count_null: bool = True) -> DataFrame:
    """column_name, data_type, unique_count, cardinality_pct; NULL counts as a value by default."""
    types = F.create_map(*[x for f in df.schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    unique = F.col("unique_count") + ((F.col("null_count") > 0).cast("bigint") if count_null else 0)
    found = distinct_values(df, df.columns).withColumn("unique_count", unique)
    return found.select(
        "column_name", types[F.col("column_name")].alias("data_type"), "unique_count",
        F.when(F.col("row_count") > 0, F.col("unique_count") / F.col("row_count") * 100.0).otherwise(F.lit(0.0)).alias("cardinality_pct"),
    )


DESCRIBE_PROBS = {0.01: "p01", 0.05: "p05", 0.25: "p25", 0.5: "p50", 0.75: "p75", 0.95: "p95", 0.99: "p99"}
QUARTILE_PROBS = {0.25: "p25", 0.5: "p50", 0.75: "p75"}


def describe(df: DataFrame, columns: Sequence[str], probs: dict[float, str] = DESCRIBE_PROBS, few_rows: bool = False) -> DataFrame:
    """Per column: count, mean, std (sample), min, exact quantiles, max (rounded to 6).

    Moments of all columns come from one aggregation pass; the quantiles of all columns come from
    the counts of the (column, value) pairs, so the input is scanned twice, whatever the number
    of columns. ``few_rows`` says that the input is small by nature (a row per hour, say): then
    Spark's own ``percentile`` answers in the pass of the moments.
    """
    cols = list(columns)
    stats = ["count", "mean", "std", "min", "max"]
    aggs = [
        agg(F.col(c).cast("double")).alias(f"{c}\u0001{name}")
        for c in cols
        for name, agg in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    ]
    if few_rows:
        stats += list(probs.values())
        aggs += [F.percentile(F.col(c).cast("double"), p).alias(f"{c}\u0001{name}") for c in cols for p, name in probs.items()]
    rows = [F.struct(F.lit(c).alias("column_name"),
                     *[F.col(f"`{c}\u0001{name}`").alias(name) for name in stats]) for c in cols]
    out = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if not few_rows:
        pair = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_value")) for c in cols]
        values = df.select(F.explode(F.array(*pair)).alias("x")).select("x.*")
        qs = pivot_quantiles(exact_quantiles(values, "_value", list(probs), ["column_name"]), ["column_name"], probs)
        out = out.join(qs, "column_name", "left")
    return out.select(
        "column_name", "count",
        *[F.round(F.col(n), 6).alias(n) for n in ["mean", "std", "min", *probs.values(), "max"]],
    )


# ------------------------------------------------------------------ grouped profiles (pandas-style: NULL keys dropped)

def type_quality_profile(raw: DataFrame) -> DataFrame:
    """Per type: count, total, mean, exact median, max, fraud, flagged, shares.

    Shares divide by all rows (NULL types included): the total is a window over
    the aggregated type groups, so no join is needed.
    """
    agg = raw.groupBy("type").agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("average_amount"),
        F.max("amount").alias("maximum_amount"),
        F.sum("isFraud").cast("bigint").alias("fraud_count"),
        F.sum("isFlaggedFraud").cast("bigint").alias("flagged_fraud_count"),
    ).withColumn("_rows", F.sum("transaction_count").over(Window.partitionBy()))
    keyed = raw.filter(F.col("type").isNotNull())
    medians = exact_quantiles(keyed, "amount", [0.5], ["type"]).select("type", F.col("quantile").alias("median_amount"))
    out = agg.filter(F.col("type").isNotNull()).join(medians, "type", "left")
    return out.select(
        "type", "transaction_count", "total_amount", "average_amount", "median_amount", "maximum_amount",
        "fraud_count", "flagged_fraud_count",
        (F.col("transaction_count") / F.col("_rows") * 100.0).alias("transaction_pct"),
        (F.col("fraud_count") / F.col("transaction_count") * 100.0).alias("fraud_rate_pct"),
    )


def flag_profile(raw: DataFrame) -> DataFrame:
    keyed = raw.filter(F.col("type").isNotNull() & F.col("isFlaggedFraud").isNotNull())
    return keyed.groupBy("type", "isFlaggedFraud").agg(
        F.count("*").alias("transaction_count"),
        F.min("amount").alias("minimum_amount"),
        F.max("amount").alias("maximum_amount"),
        F.avg("amount").alias("average_amount"),
    )


def fraud_by_type(raw: DataFrame) -> DataFrame:
    agg = raw.filter(F.col("type").isNotNull()).groupBy("type").agg(
        F.count("*").alias("transaction_count"),
        F.sum("isFraud").cast("bigint").alias("fraud_count"),
        F.sum("amount").alias("total_amount"),
    )
    rated = agg.withColumn("fraud_rate_pct", F.col("fraud_count") / F.col("transaction_count") * 100.0)
    return rated.orderBy(F.desc("fraud_rate_pct"), "type")


def hourly_profile(raw: DataFrame) -> DataFrame:
    agg = raw.filter(F.col("step").isNotNull()).groupBy("step").agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("average_amount"),
        F.sum("isFraud").cast("bigint").alias("fraud_count"),
        F.sum("isFlaggedFraud").cast("bigint").alias("flagged_fraud_count"),
    )
    return agg.withColumn("fraud_rate_pct", F.col("fraud_count") / F.col("transaction_count") * 100.0)


def hourly_profile_stats(raw: DataFrame) -> DataFrame:
    """Describe over the hourly profile (an aggregate of an aggregate, <= #steps rows)."""
    hourly = hourly_profile(raw)
    return describe(hourly, ["transaction_count", "total_amount", "fraud_count", "fraud_rate_pct"], QUARTILE_PROBS, few_rows=True)


def merchant_balance_profile(raw: DataFrame) -> DataFrame:
    merchants = raw.filter(F.col("nameDest").startswith("M"))
    return describe(merchants, ["oldbalanceDest", "newbalanceDest"], QUARTILE_PROBS)


def type_distribution(raw: DataFrame) -> DataFrame:
    """Type counts and share of all rows (round 4); the total is a window over the groups."""
    counts = raw.groupBy("type").agg(F.count("*").alias("transaction_count"))
    total = F.sum("transaction_count").over(Window.partitionBy())
    return counts.withColumn("transaction_pct", F.round(F.col("transaction_count") / total * 100.0, 4))


def fraud_distribution(raw: DataFrame) -> DataFrame:
    counts = raw.groupBy("isFraud").agg(F.count("*").alias("transaction_count"))
    total = F.sum("transaction_count").over(Window.partitionBy())
    return counts.withColumn("transaction_pct", F.round(F.col("transaction_count") / total * 100.0, 6))


def fraud_flag_crosstab(raw: DataFrame) -> DataFrame:
    """isFraud x isFlaggedFraud counts with 'All' margins (cube); NULL keys dropped."""
    keyed = raw.filter(F.col("isFraud").isNotNull() & F.col("isFlaggedFraud").isNotNull())
    cube = keyed.cube("isFraud", "isFlaggedFraud").agg(
        F.count("*").alias("transaction_count"),
        F.grouping("isFraud").alias("_gf"), F.grouping("isFlaggedFraud").alias("_gg"),
    )
    return cube.select(
        F.when(F.col("_gf") == 1, F.lit("All")).otherwise(F.col("isFraud").cast("string")).alias("is_fraud"),
        F.when(F.col("_gg") == 1, F.lit("All")).otherwise(F.col("isFlaggedFraud").cast("string")).alias("is_flagged_fraud"),
        "transaction_count",
    )


def missing_steps(raw: DataFrame, min_step: int = MIN_STEP, max_step: int = MAX_STEP) -> DataFrame:
    """Expected hourly steps with no row (anti join against the observed steps)."""
    spark = raw.sparkSession
    expected = spark.range(min_step, max_step + 1).select(F.col("id").cast("int").alias("step"))
    observed = raw.select("step").filter(F.col("step").isNotNull()).distinct()
    return expected.join(observed, "step", "left_anti")


def rows_per_partition(df: DataFrame) -> DataFrame:
    """partition_id, row_count: a row for each partition, the empty ones too.

    A pass over the partitions, each of which answers once whatever it holds.
    """
    def counted(batches):
        yield pa.RecordBatch.from_pydict(
            {"partition_id": [TaskContext.get().partitionId()], "row_count": [sum(b.num_rows for b in batches)]},
            schema=pa.schema([("partition_id", pa.int32()), ("row_count", pa.int64())]),
        )

    # One narrow column goes along; a frame without columns would lose its batches' row counts.
    return df.select(F.lit(True).alias("one")).mapInArrow(counted, "partition_id int, row_count long")


def partition_skew(df: DataFrame) -> DataFrame:
    """The summary of the rows per partition: partitions, empty ones, least, most, mean."""
    return rows_per_partition(df).agg(
        F.count("*").alias("partitions"), F.count_if(F.col("row_count") > 0).alias("non_empty_partitions"),
        F.min("row_count").alias("min_rows"), F.max("row_count").alias("max_rows"),
        F.round(F.avg("row_count"), 2).alias("avg_rows"), F.sum("row_count").alias("total_rows"),
    )


# ------------------------------------------------------------------ the check report

@dataclass(frozen=True)
class Check:
    name: str
    category: str
    severity: str
    description: str
    failed: Column | None = None      # row-level failure predicate (count_if)
    tested: Column | None = None      # row-level denominator predicate; None = all rows


def row_check_meta(columns: Sequence[str] = RAW_COLUMNS) -> list[tuple[str, str, str, str]]:
    """(name, category, severity, description) of the row checks, in report order.

    Names, categories and severities are fixed values; descriptions are this library's own text.
    """
    meta = [(f"{c}_not_null", "completeness", "ERROR", f"No row lacks {c}.") for c in columns]
    meta += [
        ("valid_transaction_type", "validity", "ERROR", "The type is one of the five known ones."),
        ("valid_step_range", "validity", "ERROR", "The step lies in the simulated month (1 to 744)."),
        ("non_negative_amount", "validity", "ERROR", "No amount is below zero."),
        ("non_zero_amount", "business_rule", "WARNING", "Amounts of zero are counted for review and kept."),
    ]
    meta += [(f"{c}_finite", "validity", "ERROR", f"No value of {c} is infinite.") for c in NUMERIC_COLUMNS]
    meta += [(f"{c}_non_negative", "validity", "ERROR", f"No value of {c} is below zero.") for c in BALANCE_COLUMNS]
    meta += [(f"{c}_binary", "validity", "ERROR", f"{c} is 0 or 1.") for c in ["isFraud", "isFlaggedFraud"]]
    meta += [
        ("valid_origin_account_format", "validity", "ERROR", "Sending accounts read C and digits."),
        ("valid_destination_account_format", "validity", "ERROR", "Receiving accounts read C or M and digits."),
        ("no_self_transfer", "business_rule", "WARNING", "Sender and receiver differ."),
        ("merchant_destination_balance_unavailable", "business_rule", "WARNING", "Balances of receiving merchants are zero, as they are not recorded."),
        ("outgoing_origin_balance_reconciliation", "consistency", "WARNING", "The sender's new balance is the old one less the amount, within the tolerance."),
        ("cash_in_origin_balance_reconciliation", "consistency", "WARNING", "After a cash-in the new balance is the old one plus the amount, within the tolerance."),
        ("fraud_transaction_type_consistency", "business_rule", "WARNING", "Fraud occurs in transfers and cash-outs only."),
        ("flagged_fraud_threshold_rule", "business_rule", "WARNING", "Flagged rows are transfers above the threshold."),
        ("high_value_transfer_flag_coverage", "business_rule", "WARNING", "Transfers above the threshold carry the flag."),
    ]
    return meta


def _row_predicates(columns: Sequence[str]) -> dict[str, tuple[Column, Column | None]]:
    """check name -> (failure predicate, denominator predicate or None for all rows)."""
    c = F.col
    t, a = c("type"), c("amount")

    def not_valid(valid: Column) -> Column:
        return ~F.coalesce(valid, F.lit(False))

    def differs_from_zero(x: Column) -> Column:  # a missing balance counts as "not zero"
        return F.coalesce(x != 0, F.lit(True))

    preds: dict[str, tuple[Column, Column | None]] = {f"{n}_not_null": (c(n).isNull(), None) for n in columns}
    preds["valid_transaction_type"] = (not_valid(t.isin(*VALID_TRANSACTION_TYPES)), None)
    preds["valid_step_range"] = (not_valid(c("step").between(MIN_STEP, MAX_STEP)), None)
    preds["non_negative_amount"] = (a < 0, None)
    preds["non_zero_amount"] = (a == 0, None)
    for n in NUMERIC_COLUMNS:
        preds[f"{n}_finite"] = (c(n).isin(float("inf"), float("-inf")), None)
    for n in BALANCE_COLUMNS:
        preds[f"{n}_non_negative"] = (c(n) < 0, None)
    for n in ["isFraud", "isFlaggedFraud"]:
        preds[f"{n}_binary"] = (not_valid(c(n).isin(0, 1)), None)
    preds["valid_origin_account_format"] = (not_valid(c("nameOrig").rlike(r"^C[0-9]+$")), None)
    preds["valid_destination_account_format"] = (not_valid(c("nameDest").rlike(r"^[CM][0-9]+$")), None)
    preds["no_self_transfer"] = (c("nameOrig") == c("nameDest"), None)
    merchant = F.coalesce(c("nameDest").startswith("M"), F.lit(False))
    preds["merchant_destination_balance_unavailable"] = (
        merchant & (differs_from_zero(c("oldbalanceDest")) | differs_from_zero(c("newbalanceDest"))), merchant)
    outgoing = F.coalesce(t.isin(*OUTGOING_TYPES), F.lit(False))
    preds["outgoing_origin_balance_reconciliation"] = (
        outgoing & (F.abs(c("oldbalanceOrg") - a - c("newbalanceOrig")) > BALANCE_TOLERANCE), outgoing)
    cash_in = F.coalesce(t == "CASH_IN", F.lit(False))
    preds["cash_in_origin_balance_reconciliation"] = (
        cash_in & (F.abs(c("oldbalanceOrg") + a - c("newbalanceOrig")) > BALANCE_TOLERANCE), cash_in)
    fraud = F.coalesce(c("isFraud") == 1, F.lit(False))
    preds["fraud_transaction_type_consistency"] = (fraud & not_valid(t.isin(*EXPECTED_FRAUD_TYPES)), fraud)
    flagged = F.coalesce(c("isFlaggedFraud") == 1, F.lit(False))
    preds["flagged_fraud_threshold_rule"] = (
        flagged & (F.coalesce(t != "TRANSFER", F.lit(True)) | F.coalesce(a <= HIGH_VALUE_THRESHOLD, F.lit(False))),
        flagged)
    big_transfer = F.coalesce((t == "TRANSFER") & (a > HIGH_VALUE_THRESHOLD), F.lit(False))
    preds["high_value_transfer_flag_coverage"] = (
        big_transfer & F.coalesce(c("isFlaggedFraud") == 0, F.lit(False)), big_transfer)
    return preds


def row_checks(columns: Sequence[str] = RAW_COLUMNS) -> list[Check]:
    """Declarative row-level checks over the raw table, in report order."""
    preds = _row_predicates(columns)
    return [Check(name, cat, sev, desc, *preds[name]) for name, cat, sev, desc in row_check_meta(columns)]


SCHEMA_CHECKS = [
    ("expected_columns_present", "schema", "ERROR", "Every column of the contract is there."),
    ("no_unexpected_columns", "schema", "WARNING", "No column is there that the contract lacks."),
    ("expected_column_order", "schema", "WARNING", "Columns come in the contract's order."),
]
DUPLICATE_CHECK = ("no_exact_duplicate_rows", "uniqueness", "ERROR", "No row repeats another in all columns.")
STEPS_CHECK = ("all_expected_steps_present", "completeness", "WARNING", "Each step of the month has a row.")

REPORT_COLUMNS = ["check_name", "check_category", "description", "severity", "records_tested",
                  "failed_records", "failure_rate_pct", "status"]


def _report_rows(df: DataFrame) -> DataFrame:
    tested = F.col("records_tested")
    return df.select(
        "check_name", "check_category", "description", "severity",
        tested.cast("bigint").alias("records_tested"),
        F.col("failed_records").cast("bigint").alias("failed_records"),
        F.when(tested > 0, F.col("failed_records") / tested * 100.0).otherwise(F.lit(0.0)).alias("failure_rate_pct"),
        F.when(F.col("failed_records") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
    )


def quality_report(raw: DataFrame, expected_columns: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """The full check report: schema checks, one-pass row checks, duplicates, missing steps."""
    drift = schema_drift(raw.columns, expected_columns)
    checks = row_checks([c for c in raw.columns])
    aggs = [F.count("*").alias("_rows")]
    for i, ch in enumerate(checks):
        aggs.append(F.count_if(ch.failed).alias(f"f{i}"))
        if ch.tested is not None:
            aggs.append(F.count_if(ch.tested).alias(f"t{i}"))
    wide = raw.agg(*aggs)

    def meta(name, category, severity, description):
        return [F.lit(name).alias("check_name"), F.lit(category).alias("check_category"),
                F.lit(description).alias("description"), F.lit(severity).alias("severity")]

    # Row checks: one struct per check, exploded from the single aggregate row.
    structs = []
    for i, ch in enumerate(checks):
        tested = F.col(f"t{i}") if ch.tested is not None else F.col("_rows")
        structs.append(F.struct(*meta(ch.name, ch.category, ch.severity, ch.description),
                                tested.alias("records_tested"), F.col(f"f{i}").alias("failed_records")))
    row_part = wide.select(F.explode(F.array(*structs)).alias("r")).select("r.*")

    schema_vals = [
        (len(drift["missing_columns"]), len(expected_columns)),
        (len(drift["unexpected_columns"]), len(raw.columns)),
        (0 if drift["column_order_matches"] else 1, 1),
    ]
    schema_part = raw.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(*meta(*SCHEMA_CHECKS[i]), F.lit(t).cast("bigint").alias("records_tested"),
                 F.lit(f).cast("bigint").alias("failed_records"))
        for i, (f, t) in enumerate(schema_vals)
    ])).alias("r")).select("r.*")

    # Exact duplicate rows beyond the first: partial aggregation combines copies map-side.
    dup_part = raw.groupBy(*raw.columns).agg(F.count("*").alias("_n")).agg(
        F.sum("_n").alias("records_tested"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).alias("failed_records"),
    ).select(*meta(*DUPLICATE_CHECK), "records_tested", "failed_records")

    steps_part = missing_steps(raw).agg(F.count("*").alias("failed_records")).select(
        *meta(*STEPS_CHECK), F.lit(MAX_STEP).cast("bigint").alias("records_tested"), "failed_records"
    )
    parts = [schema_part, row_part, dup_part, steps_part]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return _report_rows(union).select(*REPORT_COLUMNS)


def quality_failed_checks(report: DataFrame) -> DataFrame:
    return report.filter(F.col("status") == "FAIL").orderBy(F.desc("failure_rate_pct"), "check_name")


def quality_status_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(F.count("*").alias("check_count"))


def quality_category_matrix(report: DataFrame) -> DataFrame:
    """check_category x status counts, zero-filled."""
    return report.groupBy("check_category").pivot("status", ["PASS", "FAIL"]).agg(F.count(F.lit(1))).fillna(0)
