"""Bounded samples of labelled rows, for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 modulo 4 (null ids: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(labels: DataFrame, label: str, rows: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, y) of about ``rows`` labelled ids at most, none of them held out.

    A hash of the id draws them, so reruns agree. Null ids and labels are left out; an id with
    several labels has its largest.
    """
    own = labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("y")).where(~held_out(F.col("doc_id")))
    own = own.dropna().groupBy("doc_id").agg(F.max("y").alias("y"))
    n = own.count()
    return own if n <= rows else own.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < rows)
