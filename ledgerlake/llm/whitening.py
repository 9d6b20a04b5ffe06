"""Whitened embeddings, from eigenpairs that spectrum slicing finds and certifies.

An entry ``c`` counts as the integer ``x = floor(64 c) + 1000000``. Two passes give each
dimension's exact sum and the covariance, centred before multiplying; what comes to the driver
is one d x d matrix. There the leading eigenvalues are isolated one by one: the LDL^T
factorisation (with 1x1 and 2x2 pivots) of the covariance shifted by s has as many negative
pivots as there are eigenvalues below s, so counts at midpoints narrow an interval until one
eigenvalue is left in it. Inverse iteration from its middle and Rayleigh quotient iteration,
which converges cubically, give the pair; two counts beside it certify its number. Eigenvalues
that no count can part (their distance is rounding) share an interval, and a block of orthonormal
vectors is found for them. Two more passes over the whitened rows measure how far their
covariance is from the identity.

Rows: a null vector, one with a null or non-finite entry, or one with an entry whose ``x`` no long
can hold (64 c beyond 2^62) is dropped. Vectors of another length are a fit list of their own.
Equal rows and rows with null or equal ids each keep their rows. Components end where an
eigenvalue is below 1e-10 of the largest, which is as much as doubles can tell from zero; so one
vector alone, equal vectors, empty vectors and an empty table give no rows. ``deviation`` is null
where a long can't hold it. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare

SCALE, OFFSET = 64, 1_000_000
#: Least eigenvalue of a component, as a part of the largest; doubles can't certify less.
LEAST = 1e-10
#: Width at which eigenvalues count as equal, as a part of the largest.
EQUAL = 1e-13
_BIG = 1 << 62
_PIVOT = (1 + sqrt(17)) / 8


# ------------------------------------------------------------------ the spectrum, on one small matrix

def below(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of the symmetric ``a`` below ``shift``, from the pivots of LDL^T."""
    m = a - shift * np.eye(len(a))
    negative = 0
    while len(m):
        column = np.abs(m[1:, 0])
        r = int(column.argmax()) + 1 if len(column) else 0
        largest = column[r - 1] if r else 0.0
        two = False
        if largest > 0 and abs(m[0, 0]) < _PIVOT * largest:
            other = np.abs(m[r])
            other[r] = 0
            if abs(m[0, 0]) * other.max() < _PIVOT * largest**2:
                two = abs(m[r, r]) < _PIVOT * other.max()
                order = np.arange(len(m))
                order[[int(two), r]] = order[[r, int(two)]]
                m = m[np.ix_(order, order)]
        if two:
            pivot, c = m[:2, :2], m[2:, :2]
            det = pivot[0, 0] * pivot[1, 1] - pivot[0, 1] ** 2
            negative += 1 if det < 0 else 2 * int(pivot[0, 0] < 0)
            m = m[2:, 2:] - c @ np.linalg.solve(pivot, c.T)
        else:
            pivot, c = m[0, 0], m[1:, 0]
            negative += int(pivot < 0)
            m = m[1:, 1:] - (np.outer(c, c / pivot) if pivot else 0.0)
    return negative


def _solve(a: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    for nudge in (0.0, 1e-15, 1e-14):
        try:
            y = np.linalg.solve(a - (shift + nudge * np.abs(a).max()) * np.eye(len(a)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all():
            return y
    raise ArithmeticError("no shift near the eigenvalue can be solved for")


def _apart(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """``x`` without its parts along the unit vectors ``found``, as a unit vector."""
    for _ in range(2):
        for v in found:
            x = x - (v @ x) * v
        x = x / np.linalg.norm(x)
    return x


def slices(a: np.ndarray, k: int) -> Iterator[tuple[float, float, int]]:
    """Intervals (low, high, how many) that hold the ``k`` largest eigenvalues of ``a``, the largest first.

    One eigenvalue each, unless rounding hides the distance of several. They end at ``LEAST``.
    """
    d, top = len(a), float(np.abs(a).sum(axis=1).max(initial=0))  # no eigenvalue is beyond a row's sum
    if not top:
        return
    first, high = 0.0, top
    while high - first > EQUAL * top:  # the largest eigenvalue, roughly, scales the least one
        middle = (first + high) / 2
        first, high = (middle, high) if below(a, middle) < d else (first, middle)
        if high < 2 * first:
            break
    low = LEAST * high
    todo = [(low, top * (1 + 1e-15), d - below(a, low), 0)]
    given = 0
    while todo and given < k:
        low, high, above_low, above_high = todo.pop()
        n = above_low - above_high
        if not n:
            continue
        if n == 1 or high - low <= EQUAL * top:
            yield low, high, n
            given += n
            continue
        middle = (low + high) / 2
        above = d - below(a, middle)
        todo += [(low, middle, above_low, above), (middle, high, above, above_high)]


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of ``a`` (falling) and their unit eigenvectors as columns."""
    d, power = len(a), 2.0 ** np.frexp(np.abs(a).max(initial=0))[1]
    a = a / power  # exact; neither squares nor reciprocals leave the range of doubles
    top = float(np.abs(a).sum(axis=1).max(initial=0))
    rng = np.random.default_rng(0)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    for low, high, n in slices(a, k):
        number = len(values)
        if n > 1:
            block = rng.standard_normal((d, n))
            for _ in range(3):
                block = np.linalg.qr(_solve(a, (low + high) / 2, block))[0]
            for x in block.T:
                x = _apart(x, vectors)
                vectors.append(x)
                values.append(float(x @ a @ x))
            order = number + np.argsort(values[number:])[::-1]
            values[number:], vectors[number:] = [values[i] for i in order], [vectors[i] for i in order]
            continue
        while True:
            x = _apart(rng.standard_normal(d), vectors)
            for _ in range(2):
                x = _apart(_solve(a, (low + high) / 2, x), vectors)
            value = float(x @ a @ x)
            for _ in range(12):
                if not low <= value <= high or np.linalg.norm(a @ x - value * x) <= 4e-16 * sqrt(d) * top:
                    break
                x = _solve(a, value, x)
                x /= np.linalg.norm(x)
                value = float(x @ a @ x)
            # The pair is the one sought if its number is right: as many eigenvalues above it as found.
            near = 1e-14 * d * top
            if low - near <= value <= high + near and d - below(a, value + near) <= number < d - below(a, value - near):
                break
            middle = (low + high) / 2
            if high - low <= EQUAL * top:
                break
            low, high = (middle, high) if d - below(a, middle) > number else (low, middle)
        vectors.append(_apart(x, vectors))
        values.append(value)
    return np.array(values[:k]) * power, np.array(vectors[:k]).reshape(-1, d).T


# ------------------------------------------------------------------ passes over the rows

Rows = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x of these rows) for each length of a batch's vectors."""
    column = batch.column("vector")
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == d)
        some = values if len(rows) == len(lengths) else values[(starts[rows][:, None] + np.arange(d)).ravel()]
        yield rows, np.floor(SCALE * some.reshape(-1, d)).astype(np.int64) + OFFSET


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S without rounding: integers of 64 bits where they fit, else of any size."""
    big = n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, sums), default=0)
    if big < _BIG:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, tuple[int, np.ndarray]] = {}
    for b in batches:
        for rows, x in _by_length(b):
            wide = len(x) * max(int(x.max()), -int(x.min())) >= _BIG
            n, s = total.get(x.shape[1], (0, np.zeros(x.shape[1], dtype=object)))
            total[x.shape[1]] = n + len(rows), s + (x.astype(object) if wide else x).sum(axis=0).astype(object)
    for d, (n, s) in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0))],
            names=["d", "i", "n", "s"],
        )


def _float_sums(view: Rows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for key, x in view(b):
                total[key] = total.get(key, 0) + x.sum(axis=0)
        for d, s in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(s), pa.int32()), pa.array(range(len(s)), pa.int32()), pa.array(s)], names=["d", "i", "s"])

    return run


def _products(view: Rows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d, x in view(b):
                total[d] = total.get(d, 0) + x.T @ x
        for d, m in total.items():
            for i, row in enumerate(m):
                k = len(m) - i
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * k, pa.int32()), pa.array([i] * k, pa.int32()), pa.array(range(i, len(m)), pa.int32()), pa.array(row[i:])], names=["d", "i", "j", "s"]
                )

    return run


def _covariances(rows: DataFrame, view: Rows, n: dict[int, int], size: dict[int, int]) -> dict[int, np.ndarray]:
    """Per vector length d: the mean product of all pairs of the columns that ``view`` gives, a small matrix."""
    found = rows.mapInArrow(_products(view), "d int, i int, j int, s double").groupBy("d", "i", "j").agg(F.sum("s").alias("s")).collect()
    out = {d: np.zeros((size[d], size[d])) for d in n}
    for r in found:
        out[r["d"]][r["i"], r["j"]] = out[r["d"]][r["j"], r["i"]] = r["s"] / n[r["d"]]
    return out


class Fit:
    """What the rows of one vector length are whitened with."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float) -> None:
        self.n, self.sums, self.values, self.vectors, self.trace = n, sums, values, vectors, trace

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums).astype(np.float64) / self.n @ self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, components: int) -> dict[int, tuple[Fit, float]]:
    """Per vector length: the fit over all ``rows`` (vector) and the whitened covariance's largest error."""
    summed = rows.mapInArrow(_summed, "d int, i int, n long, s decimal(38,0)").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("d", "i").collect()
    n = {r["d"]: r["n"] for r in summed}
    sums: dict[int, list[int]] = {}
    for r in summed:
        sums.setdefault(r["d"], []).append(int(r["s"]))

    def deviations(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        for _, x in _by_length(b):
            d = x.shape[1]
            yield d, _centred(x, n[d], sums[d]).astype(np.float64) / n[d]

    fits: dict[int, Fit] = {}
    for d, v in _covariances(rows, deviations, n, {d: d for d in n}).items():
        values, vectors = leading(v, components)
        fits[d] = Fit(n[d], sums[d], values, vectors, float(np.trace(v)))
    size = {d: len(f.values) for d, f in fits.items() if len(f.values)}

    def whitened(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        for _, x in _by_length(b):
            if x.shape[1] in size:
                yield x.shape[1], fits[x.shape[1]].whitened(x)

    means = {d: np.zeros(k) for d, k in size.items()}
    for r in rows.mapInArrow(_float_sums(whitened), "d int, i int, s double").groupBy("d", "i").agg(F.sum("s").alias("s")).collect():
        means[r["d"]][r["i"]] = r["s"] / n[r["d"]]
    again = _covariances(rows, lambda b: ((d, w - means[d]) for d, w in whitened(b)), {d: n[d] for d in size}, size)
    return {d: (fits[d], float(np.abs(m - np.eye(len(m))).max())) for d, m in again.items()}


def _rows(fits: dict[int, tuple[Fit, float]], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, x in _by_length(b):
                if x.shape[1] not in fits:
                    continue
                f, error = fits[x.shape[1]]
                k, m = len(f.values), len(rows)
                off = _centred(x, f.n, f.sums)
                if off.dtype != object and x.shape[1] * int(np.abs(off).max()) ** 2 >= _BIG:
                    off = off.astype(object)
                exact = (off * off).sum(axis=1)
                deviation = pa.array([int(v) if v < 1 << 63 else None for v in exact], pa.int64())
                columns = [
                    b.column("vec_id").take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, f.n)),
                    deviation.take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(f.whitened(x).ravel()),
                    pa.array(np.tile(f.values / f.trace, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def whiten(df: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component."""
    prepare(df.sparkSession)
    wide = F.col(vector_col).cast("array<double>")
    fits_long = F.forall("vector", lambda c: F.coalesce(F.abs(c) < float(_BIG // SCALE), F.lit(False)))
    rows = df.select(F.col(id_col).alias("vec_id"), wide.alias("vector")).where(F.col("vector").isNotNull() & fits_long)
    fits = fit(rows.select("vector"), components)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kind = dict(rows.dtypes)["vec_id"]
    return rows.mapInArrow(_rows(fits, names), f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
