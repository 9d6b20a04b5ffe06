"""Gold marts. Each is one grouped aggregate over Silver.

Scale notes: every mart is partial + final hash aggregation, so a hot key is
combined map-side before the shuffle and the shuffle carries one row per key
and map task. Marts are returned unsorted except where the order is part of
the result (top-k); sort at the sink if a file needs it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.contracts import DEFAULT_RSD, SILVER_REQUIRED_COLUMNS, VALID_TRANSACTION_TYPES, validate_required_columns
from ledgerlake.functions import (
    count_where,
    distinct_sketch,
    exact_amount,
    money_avg,
    money_max,
    money_min,
    money_total,
    safe_pct,
    sketch_median,
    sum_where,
)

def _fraud():
    return F.col("is_fraud") == 1


def _check_rsd(rsd: float) -> None:
    if not 0 < rsd <= 0.39:
        raise ValueError(f"a relative standard deviation of {rsd} can't be kept: it must be above 0 and at most 0.39")


# ---------------------------------------------------------------- strict (M)

def daily_measures() -> list:
    return [
        F.count("*").alias("transaction_count"),
        money_total().alias("total_transaction_amount"),
        money_avg().alias("average_transaction_amount"),
        money_min().alias("minimum_transaction_amount"),
        money_max().alias("maximum_transaction_amount"),
        F.sum("is_fraud").alias("fraud_count"),
        sum_where(_fraud()).alias("fraud_amount"),
        F.sum("is_flagged_fraud").alias("flagged_fraud_count"),
        F.sum("is_high_value_transaction").alias("high_value_transaction_count"),
    ]


def _daily_rates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "fraud_rate_pct": safe_pct("fraud_count", "transaction_count"),
            "fraud_amount_pct": safe_pct("fraud_amount", "total_transaction_amount"),
        }
    )


DAILY_COLUMNS = [
    "transaction_day", "transaction_count", "total_transaction_amount", "average_transaction_amount",
    "minimum_transaction_amount", "maximum_transaction_amount", "fraud_count", "fraud_amount",
    "flagged_fraud_count", "high_value_transaction_count", "estimated_unique_origin_accounts",
    "estimated_unique_destination_accounts", "fraud_rate_pct", "fraud_amount_pct",
]


def daily_transaction_summary(silver: DataFrame, approximate_distinct_rsd: float = DEFAULT_RSD) -> DataFrame:
    """G1 in one aggregate: the HLL estimates ride in the same pass (no self join)."""
    _check_rsd(approximate_distinct_rsd)
    agg = silver.groupBy("transaction_day").agg(
        *daily_measures(),
        F.approx_count_distinct("origin_account", approximate_distinct_rsd).alias("estimated_unique_origin_accounts"),
        F.approx_count_distinct("destination_account", approximate_distinct_rsd).alias("estimated_unique_destination_accounts"),
    )
    return _daily_rates(agg).select(*DAILY_COLUMNS)


def daily_transaction_summary_join(silver: DataFrame, approximate_distinct_rsd: float = DEFAULT_RSD) -> DataFrame:
    """G1 in the reference's join form (basic measures LEFT JOIN distinct estimates).

    Kept as the J1 operator; the single-pass form above is what jobs use.
    Both sides are one row per day, so the join side is bounded by the day count.
    """
    _check_rsd(approximate_distinct_rsd)
    basic = silver.groupBy("transaction_day").agg(*daily_measures())
    accounts = silver.groupBy("transaction_day").agg(
        F.approx_count_distinct("origin_account", approximate_distinct_rsd).alias("estimated_unique_origin_accounts"),
        F.approx_count_distinct("destination_account", approximate_distinct_rsd).alias("estimated_unique_destination_accounts"),
    )
    return _daily_rates(basic.join(accounts, on="transaction_day", how="left")).select(*DAILY_COLUMNS)


def daily_type_summary(silver: DataFrame) -> DataFrame:
    agg = silver.groupBy("transaction_day", "transaction_type").agg(
        F.count("*").alias("transaction_count"),
        money_total().alias("total_transaction_amount"),
        money_avg().alias("average_transaction_amount"),
        F.sum("is_fraud").alias("fraud_count"),
        sum_where(_fraud()).alias("fraud_amount"),
    )
    return agg.withColumn("fraud_rate_pct", safe_pct("fraud_count", "transaction_count"))


def hourly_fraud_summary(silver: DataFrame) -> DataFrame:
    agg = silver.groupBy(F.col("step").alias("hourly_step")).agg(
        F.count("*").alias("transaction_count"),
        F.sum("is_fraud").alias("fraud_count"),
        money_total().alias("total_transaction_amount"),
        sum_where(_fraud()).alias("fraud_amount"),
    )
    return agg.withColumn("fraud_rate_pct", safe_pct("fraud_count", "transaction_count"))


def transaction_type_summary(silver: DataFrame) -> DataFrame:
    agg = silver.groupBy("transaction_type").agg(
        F.count("*").alias("transaction_count"),
        money_total().alias("total_transaction_amount"),
        money_avg().alias("average_transaction_amount"),
        F.sum("is_fraud").alias("fraud_count"),
        F.sum("is_flagged_fraud").alias("flagged_fraud_count"),
        F.sum("is_high_value_transaction").alias("high_value_transaction_count"),
    )
    return agg.withColumn("fraud_rate_pct", safe_pct("fraud_count", "transaction_count"))


def _account_summary(silver: DataFrame, key: str, prefix: str) -> DataFrame:
    return silver.groupBy(key).agg(
        F.count("*").alias(f"{prefix}_transaction_count"),
        money_total().alias(f"{prefix}_total_amount"),
        money_avg().alias(f"{prefix}_average_amount"),
        F.sum("is_fraud").alias(f"{prefix}_fraud_count"),
        F.max("step").alias(f"latest_{prefix}_transaction_step"),
    )


def origin_account_summary(silver: DataFrame) -> DataFrame:
    return _account_summary(silver, "origin_account", "origin")


def destination_account_summary(silver: DataFrame) -> DataFrame:
    return _account_summary(silver, "destination_account", "destination")


def high_value_summary(silver: DataFrame) -> DataFrame:
    return (
        silver.filter(F.col("is_high_value_transaction") == 1)
        .groupBy("transaction_day", "transaction_type")
        .agg(
            F.count("*").alias("high_value_transaction_count"),
            money_total().alias("high_value_total_amount"),
            money_avg().alias("high_value_average_amount"),
            F.sum("is_fraud").alias("high_value_fraud_count"),
        )
    )


FRAUD_MONITORING_COLUMNS = [
    "step", "transaction_day", "transaction_hour", "transaction_type", "amount", "origin_account",
    "destination_account", "is_fraud", "is_flagged_fraud", "is_high_value_transaction", "pipeline_run_id",
]


def fraud_monitoring(silver: DataFrame) -> DataFrame:
    """Fraud rows only; a narrow scan (filter + column pruning reach the source)."""
    return silver.filter(_fraud()).select(*FRAUD_MONITORING_COLUMNS)


# ---------------------------------------------------------------- ruled (N)

def distinct_accounts(silver: DataFrame, keys: list[str]) -> DataFrame:
    """Exact distinct origin / destination accounts per ``keys``: one scan of narrow (role, account) pairs.

    Pairs are combined before they are shuffled by (keys, role, account); whole rows are not expanded.
    """
    pair = [F.struct(F.lit(is_origin).alias("origin"), F.col(c).alias("account"))
            for is_origin, c in ((True, "origin_account"), (False, "destination_account"))]
    pairs = silver.select(*keys, F.explode(F.array(*pair)).alias("x")).groupBy(*keys, "x.origin", "x.account").agg(F.count("*"))
    return pairs.groupBy(*keys).agg(
        F.count(F.when(F.col("origin"), F.col("account"))).alias("unique_origin_accounts"),
        F.count(F.when(~F.col("origin"), F.col("account"))).alias("unique_destination_accounts"),
    )


def _with_accounts(measures: DataFrame, silver: DataFrame, keys: list[str]) -> DataFrame:
    """Measures per ``keys`` beside the distinct accounts of the same keys (NULL is a key)."""
    accounts = distinct_accounts(silver, keys).withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return measures.join(accounts, same, "left").drop(*[f"_{k}" for k in keys])


def daily_transaction_summary_exact(silver: DataFrame) -> DataFrame:
    agg = silver.groupBy("transaction_day").agg(*daily_measures())
    return _daily_rates(_with_accounts(agg, silver, ["transaction_day"]))


def hourly_fraud_profile(silver: DataFrame) -> DataFrame:
    keys = ["step", "transaction_day", "hour_of_day"]
    agg = silver.groupBy(*keys).agg(
        F.count("*").alias("transaction_count"),
        money_total().alias("total_transaction_amount"),
        F.sum("is_fraud").alias("fraud_count"),
        sum_where(_fraud()).alias("fraud_amount"),
        F.sum("is_flagged_fraud").alias("flagged_fraud_count"),
        F.sum("is_high_value_transaction").alias("high_value_transaction_count"),
    )
    return _with_accounts(agg, silver, keys).withColumns(
        {
            "fraud_rate_pct": safe_pct("fraud_count", "transaction_count"),
            "flag_coverage_pct": safe_pct("flagged_fraud_count", "fraud_count"),
        }
    )


def transaction_type_profile(silver: DataFrame) -> DataFrame:
    """Type profile with an approximate median (a bounded sketch) and the share of all rows.

    The total comes from a window over the (5-row) aggregate, not a driver-side count.
    """
    agg = silver.groupBy("transaction_type").agg(
        F.count("*").alias("transaction_count"),
        money_total().alias("total_amount"),
        money_avg().alias("average_amount"),
        F.round(sketch_median(), 2).alias("median_amount"),
        money_min().alias("minimum_amount"),
        money_max().alias("maximum_amount"),
        F.sum("is_fraud").alias("fraud_count"),
        sum_where(_fraud()).alias("fraud_amount"),
        F.sum("is_flagged_fraud").alias("flagged_fraud_count"),
        F.sum("is_high_value_transaction").alias("high_value_transaction_count"),
    )
    total = F.sum("transaction_count").over(Window.partitionBy())
    return agg.withColumns(
        {
            "transaction_pct": safe_pct(F.col("transaction_count"), total, 4),
            "fraud_rate_pct": safe_pct("fraud_count", "transaction_count"),
        }
    )


def origin_account_profile(silver: DataFrame) -> DataFrame:
    """Per origin account. Ruled Silver holds the five valid types only, so the distinct types are a
    sum of five flags; with one distinct count left (destinations) no row is expanded."""
    t = F.col("transaction_type")
    agg = silver.groupBy("origin_account").agg(
        F.count("*").alias("transaction_count"),
        money_total().alias("total_transaction_amount"),
        money_avg().alias("average_transaction_amount"),
        money_min().alias("minimum_transaction_amount"),
        money_max().alias("maximum_transaction_amount"),
        F.count_distinct("destination_account").alias("unique_destination_count"),
        sum((F.coalesce(F.max((t == v).cast("bigint")), F.lit(0)) for v in VALID_TRANSACTION_TYPES), F.lit(0).cast("bigint"))
        .alias("unique_transaction_type_count"),
        F.min("step").alias("first_transaction_step"),
        F.max("step").alias("last_transaction_step"),
        F.sum("is_fraud").alias("fraud_transaction_count"),
        sum_where(_fraud()).alias("fraud_transaction_amount"),
        F.sum("is_flagged_fraud").alias("flagged_fraud_count"),
        F.sum("is_high_value_transaction").alias("high_value_transaction_count"),
        count_where(t == "TRANSFER").alias("transfer_count"),
        count_where(t == "CASH_OUT").alias("cash_out_count"),
        count_where(t == "PAYMENT").alias("payment_count"),
    )
    return agg.withColumn("fraud_rate_pct", safe_pct("fraud_transaction_count", "transaction_count"))


def destination_account_profile(silver: DataFrame) -> DataFrame:
    agg = silver.groupBy("destination_account", "destination_category").agg(
        F.count("*").alias("received_transaction_count"),
        money_total().alias("received_total_amount"),
        money_avg().alias("received_average_amount"),
        money_max().alias("received_maximum_amount"),
        F.count_distinct("origin_account").alias("unique_origin_count"),
        F.min("step").alias("first_received_step"),
        F.max("step").alias("last_received_step"),
        F.sum("is_fraud").alias("fraud_received_count"),
        sum_where(_fraud()).alias("fraud_received_amount"),
        F.sum("is_flagged_fraud").alias("flagged_fraud_received_count"),
        F.sum("is_high_value_transaction").alias("high_value_received_count"),
    )
    return agg.withColumn("fraud_received_rate_pct", safe_pct("fraud_received_count", "received_transaction_count"))


def top_risky_destinations(silver: DataFrame, k: int = 20) -> DataFrame:
    """Top-k (the limit is the feature): TakeOrderedAndProject keeps k rows per task."""
    return (
        destination_account_profile(silver)
        .filter(F.col("fraud_received_count") > 0)
        .orderBy(F.desc("fraud_received_count"), F.desc("fraud_received_amount"), F.asc("destination_account"))
        .limit(k)
    )


def high_value_profile(silver: DataFrame) -> DataFrame:
    agg = (
        silver.filter(F.col("is_high_value_transaction") == 1)
        .groupBy("transaction_day", "transaction_type")
        .agg(
            F.count("*").alias("high_value_transaction_count"),
            money_total().alias("high_value_total_amount"),
            money_avg().alias("high_value_average_amount"),
            money_max().alias("high_value_maximum_amount"),
            F.sum("is_fraud").alias("high_value_fraud_count"),
            F.sum("is_flagged_fraud").alias("high_value_flagged_count"),
        )
    )
    return agg.withColumn("high_value_fraud_rate_pct", safe_pct("high_value_fraud_count", "high_value_transaction_count"))


FRAUD_MONITORING_PROFILE_COLUMNS = [
    "_record_hash", "step", "transaction_day", "hour_of_day", "transaction_type", "amount",
    "amount_category", "origin_account", "destination_account", "destination_category",
    "is_high_value_transaction", "is_flagged_fraud", "_pipeline_run_id", "_ingestion_timestamp", "_source_file",
]


def fraud_monitoring_profile(silver: DataFrame) -> DataFrame:
    return silver.filter(_fraud()).select(*FRAUD_MONITORING_PROFILE_COLUMNS)


def daily_type_profile(silver: DataFrame) -> DataFrame:
    agg = silver.groupBy("transaction_day", "transaction_type").agg(
        F.count("*").alias("transaction_count"),
        money_total().alias("total_amount"),
        money_avg().alias("average_amount"),
        F.sum("is_fraud").alias("fraud_count"),
        sum_where(_fraud()).alias("fraud_amount"),
        F.sum("is_flagged_fraud").alias("flagged_fraud_count"),
    )
    return agg.withColumn("fraud_rate_pct", safe_pct("fraud_count", "transaction_count"))


def raw_type_summary(raw: DataFrame) -> DataFrame:
    """Type summary on raw names (count, money stats, fraud, flagged, rate)."""
    agg = raw.groupBy("type").agg(
        F.count("*").alias("transaction_count"),
        money_total().alias("total_amount"),
        money_avg().alias("average_amount"),
        money_min().alias("minimum_amount"),
        money_max().alias("maximum_amount"),
        F.sum("isFraud").cast("bigint").alias("fraud_count"),
        F.sum("isFlaggedFraud").cast("bigint").alias("flagged_fraud_count"),
    )
    return agg.withColumn("fraud_rate_pct", safe_pct("fraud_count", "transaction_count"))


# ---------------------------------------------------------------- registry

def build_gold_tables(silver: DataFrame, approximate_distinct_rsd: float = DEFAULT_RSD,
                      include_features: bool = True) -> dict[str, DataFrame]:
    """The nine strict marts as lazy DataFrames (contract checked first)."""
    validate_required_columns(silver, SILVER_REQUIRED_COLUMNS, "silver_dataframe")
    from ledgerlake.operators.features import fraud_feature

    tables = {
        "daily_transaction_summary": daily_transaction_summary(silver, approximate_distinct_rsd),
        "daily_type_summary": daily_type_summary(silver),
        "hourly_fraud_summary": hourly_fraud_summary(silver),
        "transaction_type_summary": transaction_type_summary(silver),
        "origin_account_summary": origin_account_summary(silver),
        "destination_account_summary": destination_account_summary(silver),
        "high_value_summary": high_value_summary(silver),
        "fraud_monitoring": fraud_monitoring(silver),
    }
    if include_features:
        tables["fraud_feature"] = fraud_feature(silver)
    return tables


# ---------------------------------------------------------------- certificates of estimates

def distinct_errors(estimates: DataFrame, silver: DataFrame, keys: list[str], rsd: float = DEFAULT_RSD,
                    deviations: float = 4.0) -> DataFrame:
    """Per key: exact distinct accounts and whether each estimate lies within ``deviations`` times ``rsd``.

    ``estimates`` holds the keys and ``estimated_unique_{origin,destination}_accounts``.
    """
    exact = _with_accounts(estimates, silver, keys)

    def within(side: str) -> Column:
        true = F.col(f"unique_{side}_accounts")
        off = F.abs(F.col(f"estimated_unique_{side}_accounts") - true)
        return (off <= F.lit(deviations * rsd) * true).alias(f"{side}_estimate_within_bound")

    return exact.select(*keys, "unique_origin_accounts", "unique_destination_accounts", within("origin"), within("destination"))


# ---------------------------------------------------------------- one-pass calendar marts

def _calendar_cells(silver: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Additive measures per calendar cell (hour step and type): the one pass over the fact table.

    The step fixes the day and the hour, so there are at most steps x types cells at any data
    size, and partial aggregation leaves about that many rows a task for the shuffle.
    """
    high, fraud = F.col("is_high_value_transaction") == 1, _fraud()
    amount, none = exact_amount(), F.lit(0).cast("decimal(28,6)")
    return silver.groupBy(*keys).agg(
        F.count("*").alias("transaction_count"), F.count(amount).alias("_amounts"), F.sum(amount).alias("_sum"),
        F.min("amount").alias("_min"), F.max("amount").alias("_max"), F.sum("is_fraud").alias("fraud_count"),
        F.sum(F.when(fraud, amount).otherwise(none)).alias("_fraud_sum"),
        F.sum("is_flagged_fraud").alias("flagged_fraud_count"),
        F.sum("is_high_value_transaction").alias("high_value_transaction_count"),
        F.count(F.when(high, amount)).alias("_hv_amounts"), F.sum(F.when(high, amount)).alias("_hv_sum"),
        F.max(F.when(high, F.col("amount"))).alias("_hv_max"), F.sum(F.when(high, F.col("is_fraud"))).alias("_hv_fraud"),
        F.sum(F.when(high, F.col("is_flagged_fraud"))).alias("_hv_flagged"), *more,
    )


_CELL_MERGES = {"_min": "MIN", "_max": "MAX", "_hv_max": "MAX", "_origins": "HLL_UNION_AGG", "_destinations": "HLL_UNION_AGG"}


def _roll_up(cells: DataFrame, keys: list[str], sets: str) -> DataFrame:
    """The cells summed up for each grouping set; only these few rows are expanded."""
    measures = ", ".join(f"{_CELL_MERGES.get(c, 'SUM')}({c}) AS {c}" for c in cells.columns if c not in keys)
    names = ", ".join(keys)
    return cells.sparkSession.sql(
        f"SELECT {names}, GROUPING_ID({names}) AS _gid, {measures} FROM {{cells}} GROUP BY GROUPING SETS {sets}", cells=cells
    )


def calendar_rollup(silver: DataFrame, approximate_distinct_rsd: float = DEFAULT_RSD) -> DataFrame:
    """One pass of Silver for the five calendar / type marts, the account estimates included.

    Sets: (day), (day, type), (type), (step). High-value measures are
    conditional aggregates on the (day, type) set. Each cell keeps two HyperLogLog states of a
    few hundred bytes, which merge into the days' estimates. The result holds at most
    days + days x types + types + steps rows, so it is tiny at any data size.
    """
    _check_rsd(approximate_distinct_rsd)
    keys = ["transaction_day", "transaction_type", "step"]
    cells = _calendar_cells(silver, keys, distinct_sketch("origin_account", approximate_distinct_rsd).alias("_origins"),
                            distinct_sketch("destination_account", approximate_distinct_rsd).alias("_destinations"))
    rollup = _roll_up(cells, keys, "((transaction_day), (transaction_day, transaction_type), (transaction_type), (step))")
    return rollup.withColumns({
        "estimated_unique_origin_accounts": F.hll_sketch_estimate("_origins"),
        "estimated_unique_destination_accounts": F.hll_sketch_estimate("_destinations"),
    }).drop("_origins", "_destinations")


# GROUPING_ID bit order: transaction_day (4), transaction_type (2), step (1); 1 = rolled up.
_GID = {"day": 0b011, "day_type": 0b001, "type": 0b101, "step": 0b110}


def _total(name: str) -> Column:
    return F.round(F.col(name), 2).cast("double")


def _average(total: str, count: str) -> Column:
    return F.round(F.try_divide(F.col(total).cast("double"), F.col(count)), 2)


def calendar_marts(rollup: DataFrame) -> dict[str, DataFrame]:
    """Split a calendar rollup into the five strict marts (same values as the one-off aggregates)."""
    c = F.col
    base = rollup.withColumns(
        {
            "total_transaction_amount": _total("_sum"),
            "average_transaction_amount": _average("_sum", "_amounts"),
            "minimum_transaction_amount": F.round(c("_min"), 2),
            "maximum_transaction_amount": F.round(c("_max"), 2),
            "fraud_amount": _total("_fraud_sum"),
        }
    )

    def grain(name: str) -> DataFrame:
        return base.filter(c("_gid") == _GID[name])

    daily = _daily_rates(grain("day")).select(*DAILY_COLUMNS)
    daily_type = grain("day_type").withColumn("fraud_rate_pct", safe_pct("fraud_count", "transaction_count")).select(
        "transaction_day", "transaction_type", "transaction_count", "total_transaction_amount",
        "average_transaction_amount", "fraud_count", "fraud_amount", "fraud_rate_pct",
    )
    hourly = grain("step").withColumn("fraud_rate_pct", safe_pct("fraud_count", "transaction_count")).select(
        c("step").alias("hourly_step"), "transaction_count", "fraud_count", "total_transaction_amount",
        "fraud_amount", "fraud_rate_pct",
    )
    by_type = grain("type").withColumn("fraud_rate_pct", safe_pct("fraud_count", "transaction_count")).select(
        "transaction_type", "transaction_count", "total_transaction_amount", "average_transaction_amount",
        "fraud_count", "flagged_fraud_count", "high_value_transaction_count", "fraud_rate_pct",
    )
    high_value = grain("day_type").filter(c("high_value_transaction_count") > 0).select(
        "transaction_day", "transaction_type",
        c("high_value_transaction_count"),
        _total("_hv_sum").alias("high_value_total_amount"),
        _average("_hv_sum", "_hv_amounts").alias("high_value_average_amount"),
        c("_hv_fraud").alias("high_value_fraud_count"),
    )
    return {
        "daily_transaction_summary": daily,
        "daily_type_summary": daily_type,
        "hourly_fraud_summary": hourly,
        "transaction_type_summary": by_type,
        "high_value_summary": high_value,
    }


# ---------------------------------------------------------------- ruled calendar marts in one pass each

# GROUPING_ID bits follow the grouping columns' first appearance: day 8, step 4, hour 2, type 1.
_RULED_KEYS = ["transaction_day", "step", "hour_of_day", "transaction_type"]


def _ruled_gid(present: set[str]) -> int:
    gid = 0
    for i, k in enumerate(_RULED_KEYS):
        if k not in present:
            gid |= 1 << (len(_RULED_KEYS) - 1 - i)
    return gid


def ruled_calendar_rollup(silver_ruled: DataFrame) -> DataFrame:
    """Additive measures of the five ruled calendar marts: one pass, rolled up from its cells."""
    return _roll_up(_calendar_cells(silver_ruled, _RULED_KEYS), _RULED_KEYS,
                    "((transaction_day), (step, transaction_day, hour_of_day), (transaction_type), (transaction_day, transaction_type))")


def _distinct_per_grain(silver_ruled: DataFrame, account: str, out: str) -> DataFrame:
    """Distinct values of one account column per hour step and per day, in long form.

    (step, account) pairs are made once, with partial aggregation; the days come from the pairs.
    Both branches read the pairs' exchange, whose count column keeps the two plans the same.
    """
    hour = ["transaction_day", "step", "hour_of_day"]
    pairs = silver_ruled.groupBy(*hour, account).agg(F.count("*").alias("_n"))
    accounts = F.count(F.when(F.col("_n") > 0, F.col(account))).alias(out)
    hours = pairs.groupBy(*hour).agg(accounts).withColumn("_day_grain", F.lit(False))
    days = pairs.groupBy("transaction_day", account).agg(F.sum("_n").alias("_n")).groupBy("transaction_day").agg(accounts)
    return hours.unionByName(days.withColumn("_day_grain", F.lit(True)), allowMissingColumns=True)


def ruled_distinct_accounts(silver_ruled: DataFrame) -> DataFrame:
    """Exact distinct origin / destination accounts per day and per hour."""
    origin = _distinct_per_grain(silver_ruled, "origin_account", "unique_origin_accounts")
    destination = _distinct_per_grain(silver_ruled, "destination_account", "unique_destination_accounts")
    return origin.unionByName(destination, allowMissingColumns=True).groupBy(
        "transaction_day", "step", "hour_of_day", "_day_grain"
    ).agg(F.max("unique_origin_accounts").alias("unique_origin_accounts"),
          F.max("unique_destination_accounts").alias("unique_destination_accounts"))


def ruled_type_medians(silver_ruled: DataFrame) -> DataFrame:
    """Each task keeps one bounded sketch per type; the sketches merge."""
    return silver_ruled.groupBy("transaction_type").agg(F.round(sketch_median(), 2).alias("median_amount"))


def ruled_calendar_marts(rollup: DataFrame, distinct: DataFrame, medians: DataFrame) -> dict[str, DataFrame]:
    """Split the ruled rollup into the five ruled calendar marts (same values as the single aggregates)."""
    c = F.col
    base = rollup.withColumns(
        {
            "_total": _total("_sum"),
            "_avg": _average("_sum", "_amounts"),
            "_rmin": F.round(c("_min"), 2),
            "_rmax": F.round(c("_max"), 2),
            "_fraud_amount": _total("_fraud_sum"),
        }
    )

    def grain(*keys: str) -> DataFrame:
        return base.filter(c("_gid") == _ruled_gid(set(keys)))

    day_distinct = distinct.filter(c("_day_grain")).select("transaction_day", "unique_origin_accounts",
                                                           "unique_destination_accounts")
    hour_distinct = distinct.filter(~c("_day_grain")).select("step", "unique_origin_accounts",
                                                             "unique_destination_accounts")
    daily = grain("transaction_day").join(day_distinct, "transaction_day", "left").select(
        "transaction_day", "transaction_count", c("_total").alias("total_transaction_amount"),
        c("_avg").alias("average_transaction_amount"), c("_rmin").alias("minimum_transaction_amount"),
        c("_rmax").alias("maximum_transaction_amount"), "fraud_count", c("_fraud_amount").alias("fraud_amount"),
        "flagged_fraud_count", "high_value_transaction_count", "unique_origin_accounts",
        "unique_destination_accounts",
    )
    daily = _daily_rates(daily)
    hourly = grain("step", "transaction_day", "hour_of_day").join(hour_distinct, "step", "left").select(
        "step", "transaction_day", "hour_of_day", "transaction_count", c("_total").alias("total_transaction_amount"),
        "fraud_count", c("_fraud_amount").alias("fraud_amount"), "flagged_fraud_count",
        "high_value_transaction_count", "unique_origin_accounts", "unique_destination_accounts",
    ).withColumns({
        "fraud_rate_pct": safe_pct("fraud_count", "transaction_count"),
        "flag_coverage_pct": safe_pct("flagged_fraud_count", "fraud_count"),
    })
    by_type = grain("transaction_type").join(medians, "transaction_type", "left").select(
        "transaction_type", "transaction_count", c("_total").alias("total_amount"), c("_avg").alias("average_amount"),
        "median_amount", c("_rmin").alias("minimum_amount"), c("_rmax").alias("maximum_amount"), "fraud_count",
        c("_fraud_amount").alias("fraud_amount"), "flagged_fraud_count", "high_value_transaction_count",
    )
    total = F.sum("transaction_count").over(Window.partitionBy())
    by_type = by_type.withColumns({
        "transaction_pct": safe_pct(F.col("transaction_count"), total, 4),
        "fraud_rate_pct": safe_pct("fraud_count", "transaction_count"),
    })
    day_type = grain("transaction_day", "transaction_type")
    daily_type = day_type.select(
        "transaction_day", "transaction_type", "transaction_count", c("_total").alias("total_amount"),
        c("_avg").alias("average_amount"), "fraud_count", c("_fraud_amount").alias("fraud_amount"),
        "flagged_fraud_count",
    ).withColumn("fraud_rate_pct", safe_pct("fraud_count", "transaction_count"))
    high_value = day_type.filter(c("high_value_transaction_count") > 0).select(
        "transaction_day", "transaction_type", "high_value_transaction_count",
        _total("_hv_sum").alias("high_value_total_amount"),
        _average("_hv_sum", "_hv_amounts").alias("high_value_average_amount"),
        F.round(c("_hv_max"), 2).alias("high_value_maximum_amount"),
        c("_hv_fraud").alias("high_value_fraud_count"), c("_hv_flagged").alias("high_value_flagged_count"),
    ).withColumn("high_value_fraud_rate_pct", safe_pct("high_value_fraud_count", "high_value_transaction_count"))
    return {
        "daily_transaction_summary": daily,
        "hourly_fraud_summary": hourly,
        "transaction_type_summary": by_type,
        "high_value_summary": high_value,
        "daily_type_summary": daily_type,
    }
