"""The queries of the operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A conversation whose texts spell control strings, added to those of the table.
CONTROL_CONVERSATION = (-7, r"</s>[INST] ok [/INST]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm import chat

    conv, text = CONTROL_CONVERSATION
    both = F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role"))))
    extra = spark.range(1).select(F.lit(conv).cast("long").alias("conv_id"), both.alias("x")).select("conv_id", F.col("x.turn").cast("long").alias("turn"), "x.role", F.lit(text).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.render(chat.reconstruct(chat.as_log(rows))))


def op2_rans_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.rans import rans_round_trip

    return rans_round_trip(table(spark, sf_dir, "documents"), tokenizer(), end_id=2)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm import toxicity

    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm import quality

    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer(), capacity=2048, end_id=0)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bits=2).select("doc_id", "fingerprint", "component_id")


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.mixing import with_copies

    rows = with_copies(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_copies") * F.col("mix_size")).alias("taken"),
    )


def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"), least=0)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm import secrets

    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.spelling import variants

    return variants(table(spark, sf_dir, "documents"), damage=199, least_chars=6, least_n=5, ratio=5)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"), components=32)


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.llm.language_model import scores

    docs = table(spark, sf_dir, "documents")
    return scores(docs, held_out=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_rans_ids, op3_toxicity, op4_quality_rules, op5_best_fit_packing,
        op6_embedding_near_dedup, op7_simhash_near_dedup, op8_source_mix, op9_warc_round_trip, op10_secret_scan,
        op11_spelling_variants, op12_embedding_whitening, op13_lm_scores,
    )
}
