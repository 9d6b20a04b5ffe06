"""Rows that every operator has to take: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and thing ontion reath ershin tlyble andou enwhst hation thesor ingre".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def documents(spark, extra: str = "", n: int = 40):
    """Odd rows and some prose; ``extra`` names a column that clashes with one of a result."""
    texts = [None, "", "  \n\t ", "a", "A a\x0bA", "é ñ ß 日本語  x\u0085y \x1c z", "<|endoftext|> <|ENDOFTEXT|>", prose(1, 30_000), prose(2, 60), prose(2, 60)]
    rows = [(i, t, "en", ["a", "b", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += [(100 + i, prose(10 + i, 20 + 7 * i), "en", ["a", "b", "ü"][i % 3], 0) for i in range(n)]
    rows += [(7, "equal ids", None, "a", None), (7, "equal ids", None, "a", None), (None, "no id", "en", None, 5), (None, prose(3, 50), "en", None, 5)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumn(extra, F.lit("clash"))
    return df


def none(spark, schema: str = DOCS):
    return spark.createDataFrame([], schema)


def whole(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]
