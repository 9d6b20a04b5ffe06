import numpy as np
import pytest
import xxhash
from llm_cases import documents, none, prose, whole
from pyspark.sql import functions as F

from ledgerlake.llm import embeddings, simhash
from ledgerlake.llm.common import components
from ledgerlake.llm.queries import table


def reached(n, pairs):
    label = list(range(n))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        label[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def test_components(spark):
    rng = np.random.default_rng(0)
    pairs = [(i, i + 1) for i in range(200)] + [(500, 500 + i) for i in range(1, 300)] + [tuple(map(int, p)) for p in rng.integers(1000, 1400, (250, 2))]
    df = spark.createDataFrame([*pairs, (7, 7), (3, None)], "u long, v long")
    want = reached(1500, pairs)
    got = {r["node"]: r["component"] for r in components(df).collect()}
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {x: want[x] for x in nodes}
    assert whole(components(none(spark, "u long, v long"))) == []


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    runs = [" ".join(words)] if 0 < len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(spark):
    words = prose(99, 400).split(" ")
    rows = [(200 + i, " ".join([*words[: 10 * i], "changed", *words[10 * i + 1 :]])) for i in range(30)]
    more = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' lang", "'a' source", "0L n_chars")
    return documents(spark, extra="fingerprint").drop("fingerprint").unionByName(more)


def test_simhash_by_brute_force(spark):
    rows = near(spark).collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    label = reached(len(rows), pairs)
    smallest = {}
    for r, x in zip(rows, label, strict=True):
        ids = [i for i in (smallest.get(x), r["doc_id"]) if i is not None]
        smallest[x] = min(ids) if ids else None
    want = sorted((str(r["doc_id"]), f"{p:016x}", str(smallest[x])) for r, p, x in zip(rows, prints, label, strict=True))
    found = simhash.near_duplicates(near(spark).withColumn("component", F.lit("clash")))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in found.collect()) == want
    clash = near(spark).withColumn("sim_hash", F.monotonically_increasing_id()).withColumns({"sim_id": F.lit("x"), "SIM_NULL": F.lit(2.5), "print": F.lit(1)})
    kept = simhash.keep_one(clash)
    assert kept.columns == clash.columns and kept.count() == len(set(label))
    assert {r["sim_hash"] for r in kept.collect()} <= {r["sim_hash"] for r in clash.collect()} and {r["sim_id"] for r in kept.collect()} == {"x"}


def test_large_list_of_fingerprints():
    rng = np.random.default_rng(3)
    prints = np.unique(rng.integers(0, 1 << 12, 900).astype(np.uint64) << np.uint64(20))
    want = reached(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if int(prints[i] ^ prints[j]).bit_count() <= 2])
    assert len(prints) > simhash.LISTED and simhash._smallest(prints, 2).tolist() == want
    assert simhash._smallest(prints[:100], 2).tolist() == reached(100, [(i, j) for i in range(100) for j in range(i) if int(prints[i] ^ prints[j]).bit_count() <= 2])


def linked(spark, prints, bits=2):
    df = spark.createDataFrame([(int(np.int64(p)),) for p in prints.view(np.int64)], "print long").repartition(4)
    edges = [(int(np.uint64(r["u"] & (2**64 - 1))), int(np.uint64(r["v"] & (2**64 - 1)))) for r in simhash.links(df, bits).collect()]
    place = {int(p): i for i, p in enumerate(prints)}
    assert all((u ^ v).bit_count() > 0 for u, v in edges)
    return reached(len(prints), [(place[u], place[v]) for u, v in edges])


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_by_tally_against_all_pairs(spark, bits):
    rng = np.random.default_rng(bits)
    seeds = rng.integers(0, 1 << 63, 60).astype(np.uint64) * np.uint64(2)
    flips = np.uint64(1) << rng.integers(0, 64, (60, 40, 3)).astype(np.uint64)
    keep = rng.integers(0, 4, (60, 40))
    prints = np.concatenate([np.bitwise_xor.reduce(np.where(np.arange(3)[None, :] < keep[i][:, None], flips[i], np.uint64(0)), axis=1) ^ seeds[i] for i in range(60)])
    prints = np.unique(prints)
    want = reached(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if int(prints[i] ^ prints[j]).bit_count() <= bits])
    assert bits == 0 or len(set(want)) < len(prints)
    assert linked(spark, prints, bits) == want


def test_long_lists_are_listed_anew(spark):
    """Thousands of fingerprints that share four bytes, and so a list."""
    rng = np.random.default_rng(7)
    prints = np.unique((rng.integers(0, 1 << 13, 2500).astype(np.uint64) << np.uint64(35)) ^ np.uint64(0x1122000000003344))
    assert len(prints) > 3 * simhash.LISTED
    want = reached(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if int(prints[i] ^ prints[j]).bit_count() <= 2])
    assert linked(spark, prints) == want
    far = np.unique(rng.integers(0, 1 << 24, 1500).astype(np.uint64) << np.uint64(20))  # one list, few links
    want = reached(len(far), [(i, j) for i in range(len(far)) for j in range(i) if int(far[i] ^ far[j]).bit_count() <= 2])
    assert len(set(want)) > 700 and linked(spark, far) == want


def test_simhash_of_nothing(spark):
    assert whole(simhash.near_duplicates(none(spark))) == [] and whole(simhash.keep_one(none(spark))) == []


def groups_of_vectors(rng, n, d, groups, spread):
    """Vectors around ``groups`` directions, most of them farther from each other than the limit and some nearer."""
    centres = embeddings.unit(rng.standard_normal((groups, d)))
    x = centres[rng.integers(0, groups, n)] + rng.uniform(0.3, 1.2, (n, 1)) * spread * rng.standard_normal((n, d)) / np.sqrt(d)
    return (x * rng.uniform(0.1, 50, (n, 1))).astype(np.float32)


def check_links(got, ids, x, least=0.99):
    """Links and components against all pairs."""
    unit = embeddings.unit(x)
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    found = sum(r["n_links"] for r in got)
    assert link.sum() > 0 and least * link.sum() <= found <= link.sum()
    by_id = {r["vec_id"]: r for r in got}
    assert all(by_id[i]["n_links"] <= n for i, n in zip(ids, link.sum(axis=1), strict=True))
    label = reached(len(ids), np.argwhere(link).tolist())
    same = [by_id[i]["component_id"] == ids[x] for i, x in zip(ids, label, strict=True)]
    assert np.mean(same) >= least and all(r["kept"] == (r["component_id"] == r["vec_id"]) for r in got)


@pytest.mark.parametrize("d,spread", [(64, 0.35), (16, 0.3)])
def test_embedding_links_by_brute_force(spark, d, spread):
    """At the production settings: an index over several cells, thousands of links near the limit."""
    x = groups_of_vectors(np.random.default_rng(d), 6000, d, 700, spread)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    check_links(embeddings.near_duplicates(df).collect(), list(range(len(x))), x)


def test_each_length_links_within_itself(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "FEW", 500)
    rng = np.random.default_rng(6)
    x, y, z = groups_of_vectors(rng, 1500, 12, 200, 0.3), groups_of_vectors(rng, 300, 8, 60, 0.3), groups_of_vectors(rng, 200, 5, 50, 0.3)
    rows = [(i, v.tolist()) for i, v in enumerate([*x, *y, *z])] + [(9000, [1.0]), (9001, [2.0]), (9002, [-1.0]), (9003, [1.0] * 30)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    for at, some in ((0, x), (1500, y), (1800, z)):
        ids = list(range(at, at + len(some)))
        check_links([r for r in got if r["vec_id"] in set(ids)], ids, some)
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["vec_id"] >= 9000) == [(9000, 1, 9000), (9001, 1, 9000), (9002, 0, 9002), (9003, 0, 9003)]


@pytest.mark.parametrize("few", [0, 1000])
def test_tiny_and_huge_components(spark, monkeypatch, few):
    monkeypatch.setattr(embeddings, "FEW", few)
    x = groups_of_vectors(np.random.default_rng(1), 600, 8, 90, 0.3).astype(float)
    x = np.concatenate([x, x[:5] * 1e-200, x[:5] * 1e300, x[:5] * 5e-320])
    x[600:605, 0] += 0.0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(df).collect()}
    for k in range(5):
        assert len({got[i]["component_id"] for i in (k, 600 + k, 605 + k)}) == 1 and got[600 + k]["n_links"] >= 2 and got[605 + k]["n_links"] >= 2
    check_links(list(got.values()), list(range(len(x))), x)


@pytest.mark.parametrize("rank", [3, 6])
def test_links_of_low_rank_vectors(spark, monkeypatch, rank):
    monkeypatch.setattr(embeddings, "PER_CELL", 1)
    rng = np.random.default_rng(rank)
    x = embeddings.unit(rng.standard_normal((1500, rank)) @ rng.standard_normal((rank, 64))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(df).collect()}
    unit = embeddings.unit(x)
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    found = sum(got.values())
    assert link.sum() > 0 and 0.99 * link.sum() <= found <= link.sum()


def test_few_links_are_met_by_the_exact_bound(spark):
    x = np.random.default_rng(2).standard_normal((500, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "class long, embedding array<float>")
    index = embeddings.Index.learn(x, 20_000, 0.95)
    embeddings.raise_stop(index, df, len(x), 0.95)
    assert index.stop >= 0.1 * (1 - 1e-9)


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [float("inf"), 1.0]), (9, [1.0]), (10, [0.0, 1.0]), (None, [0.0, 3.0]), (10, [0.0, 1.0]), (11, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("size", F.lit("clash")).withColumn("class", F.lit("clash"))
    got = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(df).collect())
    alone = [(str(i), 0, i, True) for i in (4, 5, 6, 7, 8, 9, 11)]
    assert got == sorted([("1", 2, 1, True), ("2", 2, 1, False), ("3", 2, 1, False), ("10", 2, 10, True), ("10", 2, 10, True), ("None", 2, 10, False), *alone])
    assert whole(embeddings.near_duplicates(none(spark, "vec_id long, embedding array<float>"))) == []
