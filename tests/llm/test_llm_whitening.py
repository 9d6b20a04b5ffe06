import numpy as np
import pytest
from llm_cases import none, whole
from pyspark.sql import functions as F

from ledgerlake.llm import whitening
from ledgerlake.llm.queries import table

SCHEMA = "vec_id long, embedding array<float>"
DOUBLES = "vec_id long, embedding array<double>"


def symmetric(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    a = q * np.array(values, dtype=float) @ q.T
    return (a + a.T) / 2


SPECTRA = [
    np.arange(1, 41.0), np.geomspace(1e-9, 1e6, 50), [5, 5, 5, 5, 3, 3, 1, 0, 0], [7.0] * 12, [2, 2 + 1e-9, 2 + 2e-9, 1, 1 + 1e-14, 0.5],
    [1e-300, 2e-300, 5e-300], [0, 0, 0], [4.0], [1e12, 1, 1 - 1e-12],
]


@pytest.mark.parametrize("values", SPECTRA, ids=range(len(SPECTRA)))
def test_pairs_against_the_library(values):
    a = symmetric(values)
    want = np.sort(np.linalg.eigvalsh(a))[::-1]
    got, vectors = whitening.leading(a, 32)
    top = max(want[0], 0)
    want = want[want > 2e-10 * top][:32] if top else want[:0]
    assert len(got) >= len(want) and len(got) <= 32
    assert np.allclose(got[: len(want)], want, rtol=1e-12, atol=1e-13 * top)
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12)
    assert np.abs(a @ vectors - vectors * got).max(initial=0) <= 1e-12 * top


def test_inertia_counts():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 10, 33):
        for _ in range(20):
            a = rng.standard_normal((d, d))
            a = a + a.T
            a[np.diag_indices(d)] *= rng.integers(0, 2)
            values = np.linalg.eigvalsh(a)
            for s in rng.standard_normal(5) * 3:
                assert whitening.below(a, s) == int((values < s).sum())


def plain(vectors, components=32):
    """x, n * x - S as Python integers, the library's eigenpairs."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x, strict=True)]
    off = [[n * c - s for c, s in zip(row, sums, strict=True)] for row in x]
    deviation = [sum(c * c for c in row) for row in off]
    centred = np.array([[c / n for c in row] for row in off])
    v = centred.T @ centred / n
    values, vecs = np.linalg.eigh(v)
    order = np.argsort(values)[::-1][:components]
    return n, deviation, centred @ vecs[:, order] / np.sqrt(values[order]), values[order] / np.trace(v)


def test_whitening_by_brute_force(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    given = [(r["vec_id"], r["embedding"]) for r in df.orderBy("vec_id").collect() if r["embedding"] and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    n, deviation, white, explained = plain([v for _, v in given])
    rows = whitening.whiten(df).orderBy("vec_id", "component").collect()
    assert len(rows) == 32 * n and {r["n"] for r in rows} == {n}
    assert [r["vec_id"] for r in rows[::32]] == [i for i, _ in given]
    assert [r["deviation"] for r in rows[::32]] == deviation
    got = np.array([r["whitened"] for r in rows]).reshape(n, 32)
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got - sign * white).max() < 1e-8
    assert np.allclose([r["explained"] for r in rows[:32]], explained, rtol=1e-10)
    assert {r["identity_error"] for r in rows} and max(r["identity_error"] for r in rows) < 1e-9
    cov = got.T @ got / n
    assert np.abs(cov - np.eye(32)).max() < 1e-9


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in rng.standard_normal(6)]) for i in range(50)]
    odd = [(100, None), (101, [None] * 6), (102, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0]), (103, [float("inf")] * 6), (104, [1e300] * 6), (105, [])]
    more = [(None, [0.5] * 6), (7, good[7][1]), (7, good[7][1])]
    other = [(200 + i, [float(c) for c in rng.standard_normal(3)]) for i in range(20)] + [(300, [1.0])]
    df = spark.createDataFrame(good + odd + more + other, DOUBLES).withColumn("component", F.lit("clash")).withColumn("n", F.lit("clash")).withColumn("vector", F.lit(0))
    rows = whitening.whiten(df, components=5).collect()
    first = [r for r in rows if r["n"] == 53]
    assert len(first) == 53 * 5 and len(rows) == 53 * 5 + 20 * 3
    _, deviation, _, _ = plain([v for _, v in good + more])
    assert sorted(r["deviation"] for r in first if r["component"] == 1) == sorted(deviation)
    assert sum(r["vec_id"] is None for r in rows) == 5 and sum(r["vec_id"] == 7 for r in rows) == 15
    assert max(r["identity_error"] for r in rows) < 1e-10
    assert whole(whitening.whiten(none(spark, SCHEMA))) == []
    assert whole(whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA))) == []
    assert whole(whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA))) == []


def test_wide_integers_stay_exact(spark):
    rows = [(i, [float(2**50 + 3 * i), float(i * i % 7)]) for i in range(9)]
    got = whitening.whiten(spark.createDataFrame(rows, DOUBLES), components=2).collect()
    _, deviation, _, _ = plain([v for _, v in rows])
    assert sorted({(r["vec_id"], r["deviation"]) for r in got}) == [(i, d) for i, d in enumerate(deviation)]
    far = [(i, [float(i % 2) * 2.0**50, float(i)]) for i in range(4)]
    assert {r["deviation"] for r in whitening.whiten(spark.createDataFrame(far, DOUBLES)).collect()} == {None}
