import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, none, prose, whole
from pyspark.sql import functions as F

from ledgerlake.llm import quality, toxicity
from ledgerlake.llm.labelled import held_out, sample
from ledgerlake.llm.queries import table
from ledgerlake.llm.trees import fit, isotonic

LABELS = "doc_id long, quality int, toxic int"


def test_trees_learn_and_stay_monotone():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) & (x[:, 2] < 0.8)
    model = fit(x, y.astype(float), monotone={2: -1})
    assert ((model.score(x) > 0) == y).mean() > 0.97
    for _ in range(200):
        row = np.repeat(rng.random((1, 4)), 101, axis=0)
        row[:, 2] = np.linspace(0, 1, 101)
        assert (np.diff(model.score(row)) <= 1e-12).all()
    # node by node, the flat arrays say the same
    for row in x[:50]:
        total = model.base
        for node in model.roots.tolist():
            while model.left[node] != node:
                node = (model.left if row[model.feature[node]] <= model.threshold[node] else model.right)[node]
            total += model.value[node]
        assert total == pytest.approx(model.score(row[None])[0])


def test_trees_of_one_kind_or_no_rows():
    assert fit(np.zeros((0, 2)), np.zeros(0)).score(np.zeros((3, 2))).tolist() == [0.0] * 3
    assert (fit(np.zeros((9, 2)), np.ones(9)).score(np.zeros((3, 2))) > 2).all()


def test_isotonic_is_the_best_monotone_fit():
    rng = np.random.default_rng(1)
    score, y = rng.integers(0, 30, 300).astype(float), (rng.random(300) < 0.4).astype(float)
    knots, values = isotonic(score, y)
    assert (np.diff(values) >= 0).all() and (np.diff(knots) >= 0).all()
    got = np.interp(score, knots, values)
    # max over starts of min over ends of block means, the closed form
    u = np.unique(score)
    mean = lambda a, b: y[(score >= a) & (score <= b)].mean()
    want = {s: max(min(mean(a, b) for b in u if b >= s) for a in u if a <= s) for s in u}
    assert got == pytest.approx([want[s] for s in score])


def test_sample_leaves_held_out_ids_and_odd_labels(spark):
    rows = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(900)] + [(None, 1, 1), (5, None, None), (9, 1, 1), (9, 0, 0)]
    labels = spark.createDataFrame(rows, LABELS)
    got = {r["doc_id"]: r["y"] for r in sample(labels, "toxic", 10_000).collect()}
    assert set(got) == {i for i in range(900) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert got[9] == 1
    assert 60 < sample(labels, "toxic", 100).count() < 150
    assert spark.range(1).select(held_out(F.lit(None).cast("long"))).first()[0] is False


def brute_repeats(words, window=8):
    runs = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    inside = set()
    for i, r in enumerate(runs):
        if runs.count(r) > 1:
            inside |= set(range(i, i + window))
    return len(inside)


def test_statistics_by_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", " ", " ", "\n", "\x0b", "c#", "é", "\u0085", "|", "\x1c"]) for _ in range(rng.randint(0, 120)))
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
        lines, seen, dup = text.split("\n"), set(), 0
        for line in lines:
            if any(c not in " \t\n\x0b\x0c\r" for c in line):
                dup += line in seen
                seen.add(line)
        base, features = quality.statistics(text.encode())
        assert base == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, brute_repeats(words))
        assert len(features) == len(quality.FEATURES) and np.isfinite(features).all()
    assert quality.repeated_words([b"a"] * 8) == 0 and quality.repeated_words([b"a"] * 9) == 9


def test_quality_rows_and_fixed_limits(spark):
    docs = documents(spark, extra="kept")
    rows = quality.judge(docs, none(spark, LABELS)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])
    assert whole(quality.judge(none(spark), none(spark, LABELS))) == []


def held_out_rates(rows, labels, label, value):
    want = {r["doc_id"]: r[label] for r in labels.collect()}
    own = [(want[r["doc_id"]], value(r)) for r in rows if r["doc_id"] in want and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    return np.array([a for a, _ in own]), np.array([b for _, b in own])


def walked(model, x):
    """The log-odds of one row, node by node."""
    total = model.base
    for node in model.roots.tolist():
        while model.left[node] != node:
            node = int(model.left[node] if x[model.feature[node]] <= model.threshold[node] else model.right[node])
        total += model.value[node]
    return total


def plain_quality_features(text):
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(runs)
    inside = {k for i, r in enumerate(runs) if times[r] > 1 for k in range(i, i + 8)}
    joined = "".join(words)
    n, size = max(1, len(words)), max(1, len(joined.encode()))
    upper, lower = (sum(a <= c <= z for c in joined) for a, z in (("A", "Z"), ("a", "z")))
    return (
        math.log1p(len(words)), len(joined) / n, sum(c in "#*$%&|<>" for c in text) / n, (len(lines) - len(set(lines))) / max(1, len(lines)),
        len(inside) / n, upper / max(1, upper + lower),
        sum("0" <= c <= "9" for c in joined) / size, text.count("!") / n, sum(c in quality._PUNCTUATION.decode() for c in joined) / size,
        len(set(words)) / n, len(lines) / n, text.count("|") / n, max((len(w.encode()) for w in words), default=0), (upper + lower) / size,
    )


def test_quality_verdicts_by_a_plain_walk(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.train(docs, labels)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    verdicts = []
    for r in quality.judge(docs, labels).collect():
        x = plain_quality_features(texts[r["doc_id"]])
        assert np.allclose(x, quality.statistics(texts[r["doc_id"]].encode())[1])
        good = 1 / (1 + math.exp(-walked(model, x)))
        assert abs(good - r["good"]) < 1e-9
        words = len([w for w in re.split("[ \t-\r]+", texts[r["doc_id"]]) if w])
        assert r["n_words"] == words and r["kept"] == (not (words < 20 or 100 * r["n_repeat_words"] > 30 * words) and good >= 0.5)
        verdicts.append(r["kept"])
    assert 0 < sum(verdicts) < len(verdicts)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = quality.judge(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()
    # the trees' verdict; what the fixed limits reject is settled before it
    y, kept = held_out_rates([r for r in rows if not r["base_failed"]], table(spark, sf, "labels"), "quality", lambda r: r["kept"])
    assert kept[y == 1].mean() > 0.98 and kept[y == 0].mean() < 0.1


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    y, p = held_out_rates(rows, table(spark, sf, "labels"), "toxic", lambda r: r["predicted"])
    assert p[y == 1].mean() >= 0.9 and p[y == 0].mean() < 0.01
    kept = toxicity.clean(table(spark, sf, "documents"), table(spark, sf, "labels"))
    assert kept.columns == table(spark, sf, "documents").columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in rows if not r["predicted"]}


def plain_toxic_features(text, lexicon):
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    n = max(1, len(words))
    cores = [w.lower().strip(toxicity._EDGES) for w in words]
    plain = [c in toxicity.INSULTS for c in cores]
    learned = [lexicon.weight(c) > 0 for c in cores]
    hidden = [not p and not k and len(c) > 2 and lexicon.undisguised(w.lower()) for w, c, p, k in zip(words, cores, plain, learned, strict=True)]
    second = [c in toxicity.SECOND_PERSON for c in cores]
    hit = [any(x) for x in zip(plain, learned, hidden, strict=True)]
    near = sum(any(second[max(0, i - toxicity.NEAR) : i + toxicity.NEAR + 1]) for i, h in enumerate(hit) if h)
    runs, run = [], ""
    for c in [*cores, " "]:
        if len(c) == 1 and c.isalpha():
            run += c
        else:
            runs.append(run)
            run = ""
    letters = sum(len(c) == 1 and c.isalpha() for c in cores)
    spaced = sum(any(x in r for x in lexicon.all if len(x) > 3) for r in runs if len(r) > 3) if letters > 3 else 0
    joined = "".join(words)
    size = max(1, len(joined.encode()))
    upper, lower = (sum(a <= c <= z for c in joined) for a, z in (("A", "Z"), ("a", "z")))
    punctuation = sum(bytes([b]) in [bytes([x]) for x in toxicity._PLAIN_EDGES] for b in joined.encode())
    capital_words = sum(any("A" <= c <= "Z" for c in w) and not any("a" <= c <= "z" for c in w) for w in words)
    mixed = sum(not c.isalpha() and any(map(str.isalpha, c)) for c in cores)
    stretched = sum(any(a == b == d for a, b, d in zip(c, c[1:], c[2:], strict=False)) for c in cores)
    return (
        sum(plain) / n, sum(plain), sum(hidden) / n, sum(hidden), sum(learned) / n, sum(learned), sum(lexicon.weight(c) for c, k in zip(cores, learned, strict=True) if k),
        spaced, near / n, sum(second) / n, upper / max(1, upper + lower), capital_words / n, punctuation / size, text.count("!") / n, mixed / n, stretched / n,
        math.log1p(len(words)),
    )


def test_toxicity_scores_by_a_plain_walk(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    learned, model = toxicity.train(docs, labels)
    lexicon = toxicity.Lexicon(learned)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = toxicity.score(docs, labels).collect()
    for r in rows:
        x = plain_toxic_features(texts[r["doc_id"]], lexicon)
        assert np.allclose(x, toxicity.features(texts[r["doc_id"]].encode(), lexicon)), r["doc_id"]
        want = float(np.interp(walked(model.trees, x), model.knots, model.values))
        assert abs(want - r["score"]) < 1e-9 and r["predicted"] == (want >= 0.3)
    assert 0 < sum(r["predicted"] for r in rows) < len(rows)


def test_disguised_insults():
    lexicon = toxicity.Lexicon({})
    of = dict(zip(toxicity.FEATURES, toxicity.features("You are an 1d10t, st*pid, looooser, l o s e r!".encode(), lexicon), strict=True))
    assert of["disguised_n"] == 3 and of["spaced_n"] == 1 and of["near_second"] > 0
    clean = dict(zip(toxicity.FEATURES, toxicity.features(prose(3, 500).encode(), lexicon), strict=True))
    assert clean["plain_n"] == clean["disguised_n"] == clean["spaced_n"] == 0


def test_disguises_at_the_ends_of_words():
    lexicon = toxicity.Lexicon({"shit": 2.0})
    hidden = "idio+ shi+ +rash stup** mor** los** bit** tra** idio** **iot (mor**), +rash, $tupid !diot".split()
    assert all(lexicon[w.encode()] & toxicity._DISGUISED for w in hidden)
    # a mark is what the search without a skip says
    rng = random.Random(6)
    signs, pieces = [*".,;:?!\"'()*#_-@+|$[]1", "", "", ""], [*toxicity.INSULTS, "idio", "shi", "rash", "mor", "los", "bit", "tra", "iot", "thing", "loooser"]
    for _ in range(20_000):
        word = "".join(rng.choice(signs) for _ in range(2)) + rng.choice(pieces) + "".join(rng.choice(signs) for _ in range(2))
        w = toxicity.core(word.encode())
        want = w not in lexicon.all and len(w) > 2 and lexicon.undisguised(word)
        assert bool(lexicon[word.encode()] & toxicity._DISGUISED) == want, word


def test_toxicity_rows(spark):
    docs = documents(spark, extra="score")
    rows = toxicity.score(docs, none(spark, LABELS)).collect()
    assert len(rows) == docs.count() and all(r["score"] == 0 and r["predicted"] == 0 for r in rows)
    assert toxicity.clean(docs, none(spark, LABELS)).count() == docs.count()
    labels = spark.createDataFrame([(100 + i, 1, int(i % 2)) for i in range(40)] + [(None, 1, 1), (7, 1, None)], LABELS)
    toxic = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 1, F.concat(F.lit("you stupid moron "), F.coalesce("text", F.lit("")))).otherwise(F.col("text")))
    got = toxicity.clean(toxic, labels)
    assert got.columns == docs.columns
    assert not [r for r in got.collect() if (r["text"] or "").startswith("you stupid")]
    assert whole(toxicity.score(none(spark), labels)) == [] and whole(toxicity.clean(none(spark), labels)) == []
