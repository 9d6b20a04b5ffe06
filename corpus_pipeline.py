"""From raw documents to packed training sequences, one written stage after the other.

Each stage works on all rows that its predecessor kept and its decisions take effect: toxic
documents go, one document of each near-duplicate group stays, secrets are masked in the texts,
documents repeat or drop out as the mix takes them, and the rest is packed. All stages but the
last return the columns of ``documents``. How each operator treats nulls, empty and very long
texts, ties, repeated rows and empty tables is stated in its module.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import mixing, packing, secrets, simhash, toxicity
from ledgerlake.llm.common import scratch
from ledgerlake.llm.queries import table, tokenizer

#: Training on labels, hashing and branch-and-bound are not SQL.
ORACLE_SQL: str | None = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; others stay as they are."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link within two bits stays, that with the smallest id."""
    return simhash.keep_one(docs, shingle=3, bits=2)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in their texts replaced by a mark and their lengths recounted."""
    return secrets.redact(docs, length_col="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the sampling takes it, at target weights by source."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids with their sequence and offset."""
    return packing.pack(docs, tokenizer(), capacity=2048, end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("source mix", mix_sources),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        if k:
            path = scratch(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        docs = stage(spark, docs, sf_dir)
    return docs
