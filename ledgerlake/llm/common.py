"""Helpers that the operators share: staged tables, code shipping, components of a link graph."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path

#: Rows of one Arrow batch between the JVM and a Python worker. Texts average a few KB, so a
#: batch stays at a few MB; one very long text makes its own batch larger by its own size.
BATCH_ROWS = 256

#: A word, wherever a contract says word: ASCII white space separates, nothing else does.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches and send this package to the executors, once a session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_ledgerlake_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-"), "ledgerlake_pkg.zip")
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(package.rglob("*.py")):
            out.write(f, str(f.relative_to(package.parent)))
    sc.addPyFile(path)
    sc._ledgerlake_shipped = True


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session (tests) gets a folder of its own and a cluster an error.
    """
    return scratch_path(spark, name)


def staged(df: DataFrame, name: str, row_group: int = 128 << 20, heavy: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, no lineage behind it.

    The writer first looks at its memory after 100 rows, at each row of ``heavy`` ones, which are megabytes.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    out = df.write.option("compression", "zstd").option("parquet.block.size", row_group)
    if heavy:
        out = out.option("parquet.block.size.row.check.min", 1).option("parquet.page.size.row.check.min", 1)
    out.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """The ``wanted`` names, lengthened until no column has one of them (case aside)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def components(links: DataFrame) -> DataFrame:
    """Connected components: (node, component) for every node of ``links`` (u, v: long).

    ``component`` is the smallest node that links reach. Alternates two star steps (each node's
    larger neighbours, then its smaller ones, move to its smallest neighbour) until nothing
    changes, which takes a logarithmic number of rounds. Each round is two grouped minima and
    two equi-joins that adaptive execution can split at a hub; its result is a written table.
    Self-links and rows with a null are ignored. An empty table gives an empty table.
    """
    spark = links.sparkSession
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now, before = staged(links.distinct(), "links"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not mark[0] or mark == before:
            return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), "links")
