import math
import mmap
import zlib
from collections import Counter, defaultdict
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow.parquet as pq
import pytest
from llm_cases import documents, none, prose, whole
from pyspark.sql import functions as F

from ledgerlake.llm import language_model as lm
from ledgerlake.llm.elias_fano import STEP, EliasFano, Level, Trie
from ledgerlake.llm.queries import table

def out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w] + [None]


def plain(rows, discount=lm.DISCOUNT):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) with a dictionary per level."""
    count, two, three = Counter(), defaultdict(Counter), defaultdict(Counter)
    for doc_id, text in rows:
        if not held(doc_id):
            t = ["<s>", "<s>", *tokens(text)]
            count.update(t[2:])
            for a, b, c in zip(t, t[1:], t[2:], strict=False):
                two[b][c] += 1
                three[a, b][c] += 1
    n, v = sum(count.values()), len(count)

    def p(levels, c):
        if not levels:
            return (count[c] + 1) / (n + v + 1)
        seen, lower = levels[0], p(levels[1:], c)
        total = sum(seen.values())
        return max(seen[c] - discount, 0) / total + discount * len(seen) / total * lower if total else lower

    out = []
    for doc_id, text in rows:
        t = ["<s>", "<s>", *tokens(text)]
        base = sum(math.log10((count[c] + 1) / (n + v + 1)) for c in t[2:])
        score = sum(math.log10(p([three[a, b], two[b]], c)) for a, b, c in zip(t, t[1:], t[2:], strict=False))
        out.append((doc_id, held(doc_id), len(t) - 2, sum(count[c] > 0 for c in t[2:]), n, base, score))
    return out


def same(got, want):
    def key(r):
        return (r[0] is None, r[0] or 0, r[2], round(r[5], 6))

    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert abs(g[6] - w[6]) <= 3 * g[2] / (2 * STEP) + 1e-6  # three quantised numbers a token at most


def test_scores_by_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = whole(lm.scores(docs, out()))
    same(got, want)
    unseen = [r for r in got if r[1]]
    assert len(unseen) > 50 and sum(r[6] for r in unseen) > 1.05 * sum(r[5] for r in unseen)


def test_small_batches_and_many_shards(spark, monkeypatch):
    docs = table(spark, "/root/testdata/sf0.001", "documents").repartition(5)
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    monkeypatch.setattr(lm, "BATCH_BYTES", 10_000)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 500)
    monkeypatch.setattr(lm, "LOTS", 3)
    same(whole(lm.scores(docs, out())), want)


def noted(monkeypatch):
    """The staged tables of a run by name, filled as they are written."""
    tables, staged = {}, lm.staged

    def note(df, name, *args, **kinds):
        tables[name] = staged(df, name, *args, **kinds)
        return tables[name]

    monkeypatch.setattr(lm, "staged", note)
    return tables


def test_session_without_a_shuffle_width(spark, monkeypatch):
    """Words are numbered over as many parts as there are, whatever the session says of them."""
    docs = table(spark, "/root/testdata/sf0.001", "documents").repartition(5)
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    tables = noted(monkeypatch)
    monkeypatch.setattr(lm, "HOT", 200)
    monkeypatch.setattr(lm, "BATCH_BYTES", 100_000)
    width = "spark.sql.shuffle.partitions"
    small = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    before = spark.conf.get(width)
    spark.conf.unset(width)
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        same(whole(lm.scores(docs, out())), want)
    finally:
        spark.conf.set(width, before)
        for k in small:
            spark.conf.unset(k)
    assert tables["lm-words"].select("part").distinct().count() > 1


def test_batches_are_written_a_few_at_a_time(spark, monkeypatch):
    """One task may write many batches; its writer holds a set amount of them."""
    docs = table(spark, "/root/testdata/sf0.001", "documents").coalesce(1)
    tables = noted(monkeypatch)
    monkeypatch.setattr(lm, "BATCH_BYTES", 20_000)
    monkeypatch.setattr(lm, "ROW_GROUP", 100_000)
    lm.scores(docs, out())
    (path,) = tables["lm-tokens"].inputFiles()
    written = pq.ParquetFile(unquote(urlparse(path).path)).metadata
    groups = [written.row_group(k) for k in range(written.num_row_groups)]
    assert 2 < written.num_rows < 100  # fewer than the writer waits for by itself
    assert len(groups) > 2 and max(g.total_byte_size for g in groups) < 3 * lm.ROW_GROUP


def test_hot_words_are_split():
    rng = np.random.default_rng(0)
    n = 200_000
    id1, id2, spread = rng.integers(0, 5000, n), np.full(n, 77), rng.integers(-(2**62), 2**62, n)
    c2 = np.full(n, 50 * lm.HOT)
    by_word = np.bincount(lm._shard_of(id1, id2, np.ones(n, dtype=np.int64), c2, spread, 200))
    assert (by_word > 0).sum() > 30 and by_word.max() < n / 8
    by_doc = np.bincount(lm._shard_of(np.full(n, 5), id2, c2, c2, spread, 200))
    assert (by_doc > 0).sum() > 30 and by_doc.max() < n / 8
    assert len(np.unique(lm._shard_of(id1, id2, np.ones(n, dtype=np.int64), np.full(n, lm.HOT - 1), spread, 200))) == 1


def test_split_histories_still_sum_to_one(spark, monkeypatch):
    monkeypatch.setattr(lm, "HOT", 5)
    docs = documents(spark)
    got = whole(lm.scores(docs, out()))
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(map(str, (r[:5] for r in got))) == sorted(map(str, (r[:5] for r in want)))
    assert all(r[6] < 0 for r in got)


def test_odd_rows(spark):
    docs = documents(spark, "score").withColumn("batch", F.lit("clash")).withColumn("held_out", F.lit("clash")).withColumn("word", F.lit(1))
    same(whole(lm.scores(docs, out())), plain([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert whole(lm.scores(none(spark), out())) == []
    few = spark.createDataFrame([(k, t) for k, t in enumerate([None, "", " ", "a a a"])], "doc_id long, text string")
    same(whole(lm.scores(few, F.lit(False))), [(*r[:1], False, *r[2:]) for r in plain_all(few, False)])
    nothing = whole(lm.scores(few, F.lit(True)))
    assert {r[3] for r in nothing} == {0} and {r[4] for r in nothing} == {0} and {r[6] for r in nothing} == {0.0}
    text_ids = spark.createDataFrame([("x", "a b"), ("y", prose(5, 40))], "doc_id string, text string")
    assert {r[0] for r in whole(lm.scores(text_ids, F.lit(None).cast("boolean")))} == {"x", "y"}


def plain_all(df, value):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    keep = globals()["held"]
    globals()["held"] = lambda _: value
    try:
        return plain(rows)
    finally:
        globals()["held"] = keep


@pytest.mark.parametrize("n,top", [(0, 1), (1, 0), (1, 10**12), (1000, 1000), (1000, 3), (5000, 10**6), (300, 2**60), (64, 63)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n + top)
    values = np.sort(rng.integers(0, top + 1, n))
    coded = EliasFano.of(values)
    assert np.array_equal(coded[np.arange(n)], values)
    asked = np.unique(np.concatenate([values, values + 1, values - 1, rng.integers(0, top + 2, 200), [0, top, top * 2]]))
    asked = asked[asked >= 0]
    at = coded.find(asked)
    want = np.searchsorted(values, asked)
    want = np.where(np.isin(asked, values), want, -1)
    assert np.array_equal(at, want)
    if n >= 1000:
        size = sum(p.nbytes for p in coded.parts()) * 8 / n
        assert size <= 2 + max(0, math.log2(max(top / n, 1))) + 3


def test_runs_of_equal_high_bits():
    """Searches know where each run begins and ends, also of long, missing and last ones."""
    values = np.sort(np.concatenate([np.arange(300), [5] * 40, [2000, 2001, 9999]]))
    coded = EliasFano.of(values)
    highs = np.arange((9999 >> coded.low_bits) + 2)
    assert coded.low_bits > 2
    assert coded.runs().tolist() == np.searchsorted(values >> coded.low_bits, highs).tolist()
    assert coded.find(np.array([5, 299, 300, 1999, 2001, 9998, 9999, 10**12, -1])).tolist() == [5, 339, -1, -1, 341, -1, 342, -1, -1]
    assert EliasFano.of(np.zeros(0)).find(np.array([0, 1, -1])).tolist() == [-1, -1, -1]


def test_levels():
    rng = np.random.default_rng(4)
    pairs = np.unique(np.stack([rng.integers(0, 50, 400), rng.integers(0, 30, 400)], axis=1), axis=0)
    pairs = pairs[(pairs[:, 0] != 7) & (pairs[:, 0] != 0)]
    level = Level.of(pairs[:, 0], pairs[:, 1], 50)
    parents, ids = np.repeat(np.arange(-1, 50), 40), np.tile(np.arange(-1, 39), 51)
    where = {tuple(p): k for k, p in enumerate(pairs.tolist())}
    got = level.find(parents, ids)
    assert got.tolist() == [where.get((p, i), -1) for p, i in zip(parents.tolist(), ids.tolist(), strict=True)]
    first = {p: min(k for q, k in where.items() if q[0] == p) for p, _ in where}
    assert level.relative(parents, got).tolist() == [g - first[p] if g >= 0 else -1 for p, g in zip(parents.tolist(), got.tolist(), strict=True)]


def test_trie_from_a_mapped_file(tmp_path):
    rng = np.random.default_rng(9)
    ids = np.arange(40) ** 2 * 10**6
    t = np.unique(rng.integers(0, 40, (3000, 3)), axis=0)
    t = t[np.lexsort((t[:, 2], t[:, 0], t[:, 1]))]
    logs = np.full(len(ids), -2.0)
    trie = Trie.build(ids, t[:, 0], t[:, 1], t[:, 2], rng.integers(1, 9, len(t)), logs, 0.75)
    path = tmp_path / "trie"
    path.write_bytes(trie.to_bytes())
    with open(path, "rb") as f:
        mapped = Trie.open(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    asked = np.arange(45) ** 2 * 10**6 + (np.arange(45) % 7 == 3)
    q = rng.integers(0, 45, (5000, 3))
    q = q[np.lexsort((q[:, 2], q[:, 0], q[:, 1]))]
    args = (asked, q[:, 0], q[:, 1], q[:, 2], np.full(len(asked), -2.0))
    assert np.array_equal(trie.log10(*args), mapped.log10(*args))
    shuffled = rng.permutation(len(q))
    again = mapped.log10(asked, *(q[shuffled, k] for k in range(3)), args[-1])
    assert np.array_equal(again, trie.log10(*args)[shuffled])


@pytest.mark.parametrize("limit", [3, 20, 200])
def test_split_histories_learn_from_the_whole_corpus(spark, monkeypatch, limit):
    """Words, pairs and beginnings of texts that are spread over shards score as if they were together."""
    rng = np.random.default_rng(limit)
    words = np.array(["the", "of", "a", "Of", "cat", "é", *(f"w{k}" for k in range(40))])
    rows = [(k, " ".join(words[(rng.random(int(rng.integers(0, 60))) ** 3 * len(words)).astype(int)])) for k in range(400)]
    docs = spark.createDataFrame([*rows, (400, None), (400, "of the of the"), (None, "of the")], "doc_id long, text string").repartition(3)
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    monkeypatch.setattr(lm, "HOT", limit)
    monkeypatch.setattr(lm, "BATCH_BYTES", 10_000)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 500)
    monkeypatch.setattr(lm, "LOTS", 3)
    same(whole(lm.scores(docs, out())), want)
