"""Exact quantiles (linear interpolation) by counting, without ranking a row.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, so a hot group or a global profile over a huge table lands
in one task's memory. Here the input is read once:

1. Rows become counts per (group, value), combined before they are shuffled.
2. The counts are range-sorted by (group, value) and written once; the bounds
   of the ranges are sampled, so a hot group spans as many as it needs.
3. A directory holds the number of rows of each (group, range): at most one row
   per group and range. Its running sums say which range holds a wanted rank.
4. Only those ranges are read again; running sums of counts inside a range
   give the ranks that a value covers, and the few values asked for are
   interpolated.

Interpolation: ``pos = p * (n - 1)``; ``lo + (pos - floor(pos)) * (hi - lo)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path

#: So many range numbers are put into the scan's filter; beyond, the join alone selects them.
LISTED_RANGES = 1000


def value_counts(df: DataFrame, value: str, groups: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """Counts per (group, value), range-sorted and written: the groups, ``_v``, ``_n``, ``_range`` (in sort order)."""
    spark = df.sparkSession
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*groups, F.col(value).cast("double").alias("_v"))
        .agg(F.count("*").alias("_n"))
    )
    keys = [*groups, "_v"]
    ranged = counts.repartitionByRange(num_partitions, *keys) if num_partitions else counts.repartitionByRange(*keys)
    path = scratch_path(spark, "value-counts")
    ranged.withColumn("_range", F.spark_partition_id()).sortWithinPartitions(*keys).write.parquet(path)
    return spark.read.parquet(path)


def _covers(start: Column, n: Column, rank: Column) -> Column:
    return (start <= rank) & (rank < start + n)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], group_cols: Sequence[str] = (),
                    num_partitions: int | None = None) -> DataFrame:
    """One row per (group, p): group columns, ``p``, ``quantile`` (NULL values ignored, NULL is a group)."""
    groups = list(group_cols)
    counts = value_counts(df, value, groups, num_partitions)
    of_group = Window.partitionBy(*[F.col(g) for g in groups])
    earlier = of_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    directory = counts.groupBy(*groups, "_range").agg(F.sum("_n").alias("_rows")).withColumns(
        {"_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)), "_total": F.sum("_rows").over(of_group)}
    )

    def target(p: float) -> Column:
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        return F.struct(F.lit(float(p)).alias("p"), pos.alias("pos"), F.floor(pos).alias("lo"), F.ceil(pos).alias("hi"))

    here = F.filter(F.array(*[target(p) for p in probs]),
                    lambda t: _covers(F.col("_before"), F.col("_rows"), t["lo"]) | _covers(F.col("_before"), F.col("_rows"), t["hi"]))
    names = {g: f"_w{i}" for i, g in enumerate(groups)}
    wanted = directory.select(*[F.col(g).alias(w) for g, w in names.items()], F.col("_range").alias("_wr"), "_before",
                              here.alias("_targets")).filter(F.size("_targets") > 0)
    listed = [r["_wr"] for r in wanted.select("_wr").distinct().limit(LISTED_RANGES + 1).collect()]
    read = counts.filter(F.col("_range").isin(listed)) if len(listed) <= LISTED_RANGES else counts
    same = F.col("_range") == F.col("_wr")
    for g, w in names.items():
        same &= F.col(g).eqNullSafe(F.col(w))
    inside = Window.partitionBy(*[F.col(g) for g in groups], "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    placed = read.join(wanted, same).withColumn("_start", start)
    hits = placed.select(*groups, "_v", "_n", "_start", F.explode("_targets").alias("t"))
    at_lo = _covers(F.col("_start"), F.col("_n"), F.col("t.lo"))
    at_hi = _covers(F.col("_start"), F.col("_n"), F.col("t.hi"))
    found = hits.filter(at_lo | at_hi).groupBy(*groups, F.col("t.p").alias("p"), F.col("t.pos").alias("_pos"), F.col("t.lo").alias("_lo")).agg(
        F.max(F.when(at_lo, F.col("_v"))).alias("_vlo"), F.max(F.when(at_hi, F.col("_v"))).alias("_vhi")
    )
    q = F.col("_vlo") + (F.col("_pos") - F.col("_lo")) * (F.col("_vhi") - F.col("_vlo"))
    return found.select(*groups, "p", q.alias("quantile"))


def pivot_quantiles(quantiles: DataFrame, group_cols: Sequence[str], names: dict[float, str]) -> DataFrame:
    """Wide form: one column per probability, named by ``names``."""
    groups = list(group_cols)
    aggs = [F.max(F.when(F.col("p") == F.lit(float(p)), F.col("quantile"))).alias(n) for p, n in names.items()]
    return quantiles.groupBy(*groups).agg(*aggs) if groups else quantiles.agg(*aggs)


# ------------------------------------------------------------------ certificates of estimates

def rank_errors(df: DataFrame, value: str, estimates: dict[float, float | None]) -> DataFrame:
    """How far estimated quantiles are off, in ranks: p, estimate, row_count, rank_error.

    One scan counts the values below and up to each estimate. An estimate covers the ranks
    (below, up to]; its error is the distance of ``p * row_count`` from them over ``row_count``.
    """
    v = F.col(value).cast("double")
    known = {p: e for p, e in estimates.items() if e is not None}
    cells = df.agg(
        F.count(v).alias("n"),
        *[F.count_if(v < F.lit(float(e))).alias(f"b{i}") for i, e in enumerate(known.values())],
        *[F.count_if(v <= F.lit(float(e))).alias(f"u{i}") for i, e in enumerate(known.values())],
    )
    rows = []
    for i, (p, e) in enumerate(known.items()):
        rank = F.lit(float(p)) * F.col("n")
        off = F.greatest(F.col(f"b{i}") - rank, rank - F.col(f"u{i}"), F.lit(0.0))
        rows.append(F.struct(F.lit(float(p)).alias("p"), F.lit(float(e)).alias("estimate"), F.col("n").alias("row_count"),
                             F.try_divide(off, F.col("n")).alias("rank_error")))
    if not rows:
        return cells.select(F.lit(None).cast("double").alias("p"), F.lit(None).cast("double").alias("estimate"),
                            F.col("n").alias("row_count"), F.lit(None).cast("double").alias("rank_error")).filter(F.lit(False))
    return cells.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
