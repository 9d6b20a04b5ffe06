from collections import Counter

import pytest
from llm_cases import DOCS, documents, none, prose, whole
from pyspark.sql import functions as F
from test_llm_dedup import plain_fingerprint, reached

import corpus_pipeline
from ledgerlake.llm import mixing, secrets, toxicity
from ledgerlake.llm.queries import table

SF = "/root/testdata/sf0.001"
#: Names that the stages use themselves.
OWN = ["sim_id", "SIM_NULL", "sim_hash", "mix_size", "mix_source", "mix_copy", "mix_part", "score", "predicted", "spans", "component", "print", "row", "label"]


def clashing(df):
    return df.withColumns({c: F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id"), F.lit(-1))) for c in OWN})


def key(r):
    return tuple(str(x) for x in r)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_each_stage_on_odd_rows(spark, stage):
    name, run = stage
    docs = clashing(documents(spark))
    out = run(spark, docs, SF)
    if name == "best-fit packing":
        assert {str(r["doc_id"]) for r in out.collect()} == {str(r["doc_id"]) for r in docs.collect()}
        return
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    given, got = Counter(map(key, docs.collect())), Counter(map(key, out.collect()))
    if name == "secret scans":
        untouched = [c for c in docs.columns if c not in ("text", "n_chars")]
        assert Counter(map(key, docs.select(untouched).collect())) == Counter(map(key, out.select(untouched).collect()))
    else:
        assert set(got) <= set(given) and (name == "source mix" or all(n <= given[r] for r, n in got.items()))


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_each_stage_on_nothing(spark, stage):
    assert whole(stage[1](spark, none(spark), SF)) == []
    blank = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "a", 0)], DOCS)
    assert stage[1](spark, blank, SF).count() >= 0


def test_stages_by_plain_versions(spark):
    """Each stage's rows from what the one before it kept, by a plain version of its decision."""
    stages = [run for _, run in corpus_pipeline.STAGES]
    docs = table(spark, SF, "documents").cache()
    clean = stages[0](spark, docs, SF).cache()
    verdicts = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, table(spark, SF, "labels")).collect()}
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, bad in verdicts.items() if not bad)

    rows = clean.collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    label = reached(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    least = {}
    for r, x in zip(rows, label, strict=True):
        least[x] = min(least.get(x, r["doc_id"]), r["doc_id"])
    single = stages[1](spark, clean, SF).cache()
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(least.values())

    masked = stages[2](spark, single, SF).cache()
    ratio = secrets.train(single)
    after = {r["doc_id"]: (r["text"], r["n_chars"]) for r in masked.collect()}
    for r in single.collect():
        text = (r["text"] or "").encode()
        want = secrets.redacted(text, secrets.spans(text, ratio), b"[SECRET]").decode()
        assert (after[r["doc_id"]][0] or "") == want
        assert not any(p.search(want.encode()) for p in (secrets.ACCESS, secrets.HEX))

    mixed = stages[3](spark, masked, SF).cache()
    copies = {r["doc_id"]: r["mix_copies"] for r in mixing.with_copies(masked).collect()}
    assert Counter(r["doc_id"] for r in mixed.collect()) == +Counter(copies)

    packed = stages[4](spark, mixed, SF).collect()
    pieces = Counter(r["doc_id"] for r in packed if r["piece"] == 0)
    assert pieces == +Counter(copies)
    room = Counter()
    for r in packed:
        room[r["sequence_id"]] += r["length"]
    assert max(room.values()) <= 2048
    assert len(packed) and corpus_pipeline.run(spark, SF).agg(F.sum("length")).first()[0] == sum(room.values())


def test_planted_rows_take_effect(spark):
    """A secret, a copy and a source of its own go through all stages."""
    copy = prose(77, 120)
    rows = [(10_000 + i, copy, "en", "x", len(copy)) for i in range(5)] + [(10_100, prose(5, 60) + " password=hunter2hunter2 " + prose(6, 60), "en", "x", 0)]
    docs = table(spark, SF, "documents").select(*[c.split()[0] for c in DOCS.split(", ")]).unionByName(spark.createDataFrame(rows, DOCS))
    for name, run in corpus_pipeline.STAGES[:4]:
        docs = run(spark, docs, SF).cache()
        planted = {r["doc_id"]: r["text"] for r in docs.where("doc_id >= 10000").collect()}
        if name == "SimHash near-dedup":
            assert set(planted) == {10_000, 10_100}
        if name == "secret scans":
            assert "hunter2" not in planted[10_100] and planted[10_000] == copy
