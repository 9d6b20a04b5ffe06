import re
import zlib
from collections import Counter

from llm_cases import documents, none, whole
from pyspark.sql import functions as F

from ledgerlake.llm import spelling
from ledgerlake.llm.queries import table

COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def plain(rows, damage=199, least_chars=6, least_n=5, ratio=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= least_chars
    n = {w: c for w, c in counts.items() if c >= least_n}
    letters = {c for w in n for c in w}
    near, form = {}, {}
    for w in n:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + k :] for i in range(len(w) + 1) for c in letters for k in (0, 1) if i + k <= len(w)}
        near[w] = [x for x in edits if x in n and x != w]
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None

    def last(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, n[w], len(near[w]), form[w], n.get(form[w]), last(w)) for w in n)


def result(df):
    return sorted(whole(df.select(COLUMNS)), key=lambda r: r[0])


def test_variants_by_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain(rows)
    assert sum(r[3] is not None for r in want) > 20 and sum(r[2] for r in want) > 200
    assert result(spelling.variants(docs)) == want


def test_edits_at_every_place(spark):
    words = {"banana": 700, "bananna": 60, "bannana": 60, "bannnana": 9, "anana": 300, "anàna": 30, "xanana": 6, "banan": 7, "bananas": 7, "baxana": 1, "aaaaaa": 40, "aaaaaaa": 8, "aaaaa": 3}
    rows = [(1, " ".join([w] * k)) for w, k in words.items()] + [(2, "BANANA banaña BanAÑA Ñanana×÷ 3banana_ba")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for damage in (10**12, 3):
        for least_chars in (3, 6):
            got = result(spelling.variants(df, damage=damage, least_chars=least_chars, least_n=2, ratio=2))
            assert got == plain(rows, damage, least_chars, 2, 2)


def test_long_chains_reach_their_root(spark):
    stem = "abcdefgh"
    rows = [(k, " ".join([stem + "z" * k] * 2 ** (12 - k))) for k in range(12)]
    got = result(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), damage=10**12, least_n=1, ratio=2))
    assert {r[5] for r in got} == {stem} and len(got) == 12


def test_odd_rows(spark):
    docs = documents(spark, "word").withColumn("n", F.lit("clash")).withColumn("prefix", F.lit(1))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(spelling.variants(docs)) == plain(rows)
    assert whole(spelling.variants(none(spark))) == []
    assert whole(spelling.variants(spark.createDataFrame([(1, None), (2, ""), (3, "a b c")], "doc_id long, text string"))) == []


def test_groups_are_bounded_by_the_alphabet(spark):
    words = [f"{a}{b}cdefg" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    listed = spelling.rotations(spark.createDataFrame([(w, 5) for w in words], "word string, n long"))
    assert listed.groupBy("prefix").count().agg(F.max("count")).first()[0] <= 27
    assert listed.count() == sum(2 * len(w) + 1 for w in words)
