"""Mixing sources to target weights by systematic sampling.

All documents of a source have the same expected number of copies: the source's target over its
size. A prefix sum of these, in the order of document sizes, plus one random offset a source
crosses integers; a document is emitted once for each that it crosses. As sizes ascend along
the prefix sum, a source's taken words differ from its target by little more than its largest
document.

The prefix sum is the expected copies times a rank. Ranks come from a range partitioning by
(source, size, hash): a row number within each range's share of a source plus the rows of that
source in earlier ranges, so that a hot source spreads over as many tasks as it needs.

Rows: null texts have size 0; null sources are one source, the last; ids may be null or repeat,
each row is a document; rows equal in id, size and text are interchangeable. A source whose
words are 0 takes none (its copies are 0). An empty table gives an empty table. Columns that
the operator adds have the prefix ``mix_``; others pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import n_words, staged

#: Binary digits of a random offset; with so few, offset plus rank times 3 is exact.
OFFSET_BITS = 16
MOST_COPIES = 3


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES) -> DataFrame:
    """Adds mix_target to (mix_source, mix_source_size): shares by weight, at most ``most`` times a size.

    Weights go round in code point order, null last. The excess goes to the others by weight
    until none is above: in ascending order of cap over weight, the first k sources are capped,
    for the smallest k at which the next one's share of the rest is within its cap. One row per
    source goes through these windows.
    """
    by_name = Window.orderBy(F.col("mix_source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("w", w).withColumn("cap", F.col("mix_source_size") * most)
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("mix_source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = rows.withColumn("share", (F.sum("mix_source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    level = F.min(F.when(F.col("share") * F.col("w") <= F.col("cap"), F.struct(F.row_number().over(by_ratio).alias("k"), "share"))).over(everything)["share"]
    rows = rows.withColumn("level", level)
    return rows.withColumn("mix_target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w"))).drop("w", "cap", "share", "level")


def offset(source: Column, seed: int) -> Column:
    """The source's random offset in [0, 1), fixed by seed and name."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source))))
    return F.conv(F.substring(key, 1, OFFSET_BITS // 4), 16, 10).cast("double") / float(1 << OFFSET_BITS)


#: What ``with_copies`` adds to the columns kept.
ADDED = ["mix_size", "mix_source_size", "mix_target", "mix_copies"]
_OWN = [*ADDED, "mix_source", "mix_key", "mix_at", "mix_part"]


def with_copies(docs: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) plus mix_size, mix_source_size, mix_target and mix_copies, a row per document.

    A column of ``docs`` that is called like one of the operator's own is not kept.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in _OWN]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col(source_col).alias("mix_source"),
        n_words(text).alias("mix_size"),
        F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"), F.md5(text))).alias("mix_key"),
    )
    order = [F.col("mix_source").asc_nulls_last(), F.col("mix_size"), F.col("mix_key")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # A running number whose upper bits are the range, in the order of the prefix sum.
    rows = staged(rows.withColumn("mix_at", F.monotonically_increasing_id()).drop("mix_key"), "mix")
    rows = rows.withColumn("mix_part", F.shiftright("mix_at", 33))
    # At most as many rows as sources and ranges together.
    parts = rows.groupBy("mix_source", "mix_part").agg(F.sum("mix_size").alias("words"), F.count("*").alias("n"), F.min("mix_at").alias("first"))
    sources = targets(parts.groupBy("mix_source").agg(F.sum("words").alias("mix_source_size")))
    earlier = Window.partitionBy("mix_source").orderBy("mix_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    same = F.col("a.mix_source").eqNullSafe(F.col("b.mix_source"))
    parts = parts.alias("a").join(sources.alias("b"), same).select("a.mix_source", "mix_part", "first", "before", "mix_source_size", "mix_target")
    # Written, so that the next join's plan rests on its true size.
    parts = staged(parts, "mix-parts")
    rate = F.when(F.col("b.mix_source_size") > 0, F.col("b.mix_target") / F.col("b.mix_source_size")).otherwise(F.lit(0.0))
    rank = (F.col("a.mix_at") - F.col("b.first") + F.col("b.before") + 1).cast("double")
    start = offset(F.col("a.mix_source"), seed)
    copies = F.floor(start + rate * rank) - F.floor(start + rate * (rank - 1))
    joined = rows.alias("a").join(parts.alias("b"), same & (F.col("a.mix_part") == F.col("b.mix_part")))
    return joined.select(
        *[F.col(f"a.`{c}`") for c in rows.columns if c not in ("mix_source", "mix_part", "mix_at")],
        "b.mix_source_size", "b.mix_target", copies.cast("long").alias("mix_copies"),
    )


def mix(docs: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix: rows of ``docs``, each as often as the sampling takes it."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # nested, so that no name of it can clash
    rows = docs.select(whole, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    rows = with_copies(rows, seed, keep=["row"])
    rows = rows.where("mix_copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
    return rows.select("row.*")
