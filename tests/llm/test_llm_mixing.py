import random
from collections import Counter

import pytest
from llm_cases import DOCS, documents, none, whole
from pyspark.sql import functions as F

from ledgerlake.llm.mixing import mix, targets, with_copies


def filled(sizes, weights):
    """Targets by sharing the excess again until none is above its cap."""
    total, caps = sum(sizes), [3 * s for s in sizes]
    capped = set()
    while True:
        rest = total - sum(caps[i] for i in capped)
        w = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        out = [caps[i] if i in capped else rest * weights[i] / w for i in range(len(sizes))]
        above = {i for i in range(len(sizes)) if i not in capped and out[i] > caps[i]}
        if not above:
            return out
        capped |= above


def test_targets(spark):
    rng = random.Random(1)
    for _ in range(4):
        n = rng.randint(1, 9)
        sizes = [int(10 ** rng.uniform(0, 5)) for _ in range(n)]
        names = sorted(f"s{i}" for i in range(n - 1)) + [None]
        df = spark.createDataFrame(list(zip(names, sizes, strict=True)), "mix_source string, mix_source_size long")
        got = {r["mix_source"]: r["mix_target"] for r in targets(df).collect()}
        want = filled(sizes, [1 + i % 3 for i in range(n)])
        assert [got[k] for k in names] == pytest.approx(want, rel=1e-12)


def test_taken_words_come_near_targets(spark):
    docs = documents(spark, extra="mix_size_", n=60).withColumns({c: F.lit("clash") for c in ("mix_size", "mix_copies", "mix_source", "MIX_AT", "before")})
    rows = with_copies(docs)
    assert {*documents(spark).columns, "mix_size_", "before", "mix_copies"} < set(rows.columns) and len(rows.columns) == 11
    found = rows.collect()
    assert len(found) == docs.count()
    for r in found:
        assert 0 <= r["mix_copies"] <= 3
        assert r["mix_size"] == len([w for w in (r["text"] or "").replace("\x0b", " ").replace("\n", " ").replace("\t", " ").split(" ") if w])
    for s in {r["source"] for r in found}:
        own = [r for r in found if r["source"] == s]
        taken = sum(r["mix_copies"] * r["mix_size"] for r in own)
        assert abs(taken - own[0]["mix_target"]) <= 3 * max(r["mix_size"] for r in own)
    again = with_copies(docs.repartition(5)).collect()
    key = lambda r: (str(r["doc_id"]), r["text"] or "", r["mix_copies"])
    assert sorted(map(key, found)) == sorted(map(key, again))


def test_documents_repeat_as_often_as_they_are_taken(spark):
    docs = documents(spark).withColumns({c: F.lit(c) for c in ("mix_size", "mix_copies", "mix_source", "mix_copy", "row", "mix_part", "a.b")})
    copies = Counter()
    for r in with_copies(docs).collect():
        copies[r["doc_id"], r["text"]] += r["mix_copies"]
    out = mix(docs)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == +copies


def test_one_hot_source_over_many_ranges(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 37 + 1).cast("int")).alias("text"), F.lit("en").alias("lang"), F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"), F.lit(0).cast("long").alias("n_chars"))
    rows = with_copies(docs, keep=["doc_id", "source"]).groupBy("source").agg(F.sum(F.col("mix_copies") * F.col("mix_size")).alias("taken"), F.first("mix_target").alias("target"))
    for r in rows.collect():
        assert abs(r["taken"] - r["target"]) <= 37


def test_no_documents_and_no_words(spark):
    assert whole(with_copies(none(spark))) == [] and whole(mix(none(spark))) == []
    empty = spark.createDataFrame([(1, None, "en", "a", 0), (2, "", "en", None, 0)], DOCS)
    assert [r["mix_copies"] for r in with_copies(empty).collect()] == [0, 0]
