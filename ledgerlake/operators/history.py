"""Prior-history features per key without putting one key into one task.

``prior_history_window`` is a window partitioned by the key. A key that holds a
third of all rows becomes one task there.

``prior_history_scan`` computes the same columns as a distributed prefix scan,
in DataFrame operations only:

1. Rows get a tie-break among identical rows (``_tb``; only identical rows tie
   on the order key, so which copy comes first does not change the bag of
   results) and are range-partitioned on (key, order..., _tb). A hot key spans
   as many ranges as its rows need. The ranges are written once by a reliable
   ``checkpoint``, since their bounds are sampled per exchange.
2. Totals per (key, range), summed over a key's earlier ranges, are the carry
   of a range's first key: at most one row per range.
3. Windows over (key, range) give the history inside a range; the carry is
   joined by range number first, so the rows shuffle once, evenly.

Sums are over ``decimal(28,6)`` and turn into doubles at the end, so neither
the order of addition nor the split into ranges changes a digit: both forms
return the same values. NULL amounts are skipped as by ``sum`` and ``max``;
amounts that are not finite do not add to a sum. Keys may have any type, and
NULL is a key of its own in both forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import exact_amount
from ledgerlake.session import checkpoint_root

PRIOR_COLUMNS = [
    "_prior_count", "_prior_sum", "_prior_max", "_prior_fraud", "_prev_step", "_prev_amount",
]


def prior_history_window(df: DataFrame, key: str, order: list[str], amount: str = "amount",
                         fraud: str = "is_fraud", step: str = "step") -> DataFrame:
    """One window partitioned by ``key``."""
    w = Window.partitionBy(key).orderBy(*order)
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns(
        {
            "_prior_count": F.count("*").over(prior),
            "_prior_sum": F.sum(exact_amount(amount)).over(prior).cast("double"),
            "_prior_max": F.max(amount).over(prior),
            "_prior_fraud": F.sum(fraud).over(prior).cast("bigint"),
            "_prev_step": F.lag(step, 1).over(w),
            "_prev_amount": F.lag(amount, 1).over(w),
        }
    )


def prior_history_scan(df: DataFrame, key: str, order: list[str], amount: str = "amount",
                       fraud: str = "is_fraud", step: str = "step",
                       num_partitions: int | None = None) -> DataFrame:
    """Skew-safe equivalent of :func:`prior_history_window` (see module doc)."""
    checkpoint_root(df.sparkSession)
    sort_cols = [key, *order, "_tb"]
    tied = df.withColumn("_tb", F.monotonically_increasing_id())
    ranged = (tied.repartitionByRange(num_partitions, *sort_cols) if num_partitions
              else tied.repartitionByRange(*sort_cols))
    ranged = ranged.withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)

    totals = ranged.groupBy(F.col(key).alias("_c_key"), "_pid").agg(
        F.count("*").alias("n"), F.sum(exact_amount(amount)).alias("total"), F.max(amount).alias("most"),
        F.sum(fraud).alias("frauds"),
        F.max_by(F.struct(F.col(step).alias("step"), F.col(amount).alias("amount")), F.struct(*order, "_tb")).alias("last"),
    )
    by_key = Window.partitionBy("_c_key").orderBy("_pid")
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        "_pid", "_c_key", F.sum("n").over(earlier).alias("_c_n"), F.sum("total").over(earlier).alias("_c_total"),
        F.max("most").over(earlier).alias("_c_most"), F.sum("frauds").over(earlier).alias("_c_frauds"),
        F.lag("last", 1).over(by_key).alias("_c_last"),
    ).filter(F.col("_c_n").isNotNull())

    w = Window.partitionBy(key, "_pid").orderBy(*order, "_tb")
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.join(carry, "_pid", "left").withColumns(
        {
            "_n": F.count("*").over(prior), "_total": F.sum(exact_amount(amount)).over(prior),
            "_most": F.max(amount).over(prior), "_frauds": F.sum(fraud).over(prior),
            "_last": F.lag(F.struct(F.col(step).alias("step"), F.col(amount).alias("amount")), 1).over(w),
        }
    )
    goes_on = F.col("_c_n").isNotNull() & F.col(key).eqNullSafe(F.col("_c_key"))

    def carried(name: str) -> Column:
        return F.when(goes_on, F.col(name))

    def plus(name: str, carry_name: str) -> Column:
        a, b = F.col(name), carried(carry_name)
        return F.coalesce(a + b, a, b)

    last = F.when(F.col("_n") > 0, F.col("_last")).otherwise(carried("_c_last"))
    return rows.select(
        *df.columns,
        plus("_n", "_c_n").alias("_prior_count"),
        plus("_total", "_c_total").cast("double").alias("_prior_sum"),
        F.greatest(F.col("_most"), carried("_c_most")).alias("_prior_max"),
        plus("_frauds", "_c_frauds").cast("bigint").alias("_prior_fraud"),
        last["step"].alias("_prev_step"),
        last["amount"].alias("_prev_amount"),
    )


HOT_KEY_ROWS_CONF = "ledgerlake.history.hotKeyRows"
DEFAULT_HOT_KEY_ROWS = 2_000_000


def prior_history(df: DataFrame, key: str, order: list[str], amount: str = "amount", fraud: str = "is_fraud",
                  step: str = "step", hot_key_rows: int | None = None, num_partitions: int | None = None,
                  key_counts: DataFrame | None = None) -> DataFrame:
    """Ordinary keys by the window, hot keys by the prefix scan; the values do not depend on which.

    A key is hot when it holds more than ``hot_key_rows`` rows (session conf
    ``ledgerlake.history.hotKeyRows``), which bounds a window task. The joins
    that part the rows carry no hint: adaptive execution broadcasts the hot keys
    where their measured size allows it. NULL is a key like any other.
    ``key_counts`` (columns ``key``, ``_key_rows``) reuses rows-per-key that a job
    already computed (e.g. a written per-account summary) instead of a new pass.
    """
    spark = df.sparkSession
    limit = hot_key_rows or int(spark.conf.get(HOT_KEY_ROWS_CONF, str(DEFAULT_HOT_KEY_ROWS)))
    counts = key_counts if key_counts is not None else df.groupBy(key).agg(F.count("*").alias("_key_rows"))
    hot = counts.filter(F.col("_key_rows") > limit).select(F.col(key).alias("_hot_key"))
    if hot.isEmpty():
        return prior_history_window(df, key, order, amount, fraud, step)
    same = F.col(key).eqNullSafe(F.col("_hot_key"))
    cold = prior_history_window(df.join(hot, same, "left_anti"), key, order, amount, fraud, step)
    warm = prior_history_scan(df.join(hot, same, "left_semi"), key, order, amount, fraud, step, num_partitions)
    return cold.unionByName(warm.select(*cold.columns))
