"""Embedding near-duplicates by an inverted multi-index.

Unit vectors are cut in halves, each with its own codebook (k-means on a bounded sample); a
vector's cell in the product grid is its nearest code of either half. A query visits cells in
ascending order of how far it is, at least, from them: the squared distances to the hyperplanes
that part its own codes from the cell's. It stops where the target recall is reached; that
point is measured on vectors of the sample turned by exactly the least linking angle, and raised
to what the true links of about ``QUERIES`` vectors with all others need. Where these have too
few links to tell, it is the exact bound, the squared distance at the least linking cosine. Of two
cells the vectors of the larger visit the smaller, so a pair is met once. Met vectors are
verified by their cosine in double precision.

Equal vectors are one class with its size. Cells are split into blocks of about ``BLOCK``, so
a task never has more than two blocks, whatever a cell holds. A block pair gives counts and, for
what it links, one edge per vector, never its pairs.

Vectors of different lengths have no cosine, so each length has an index of its own; lengths with
``FEW`` different vectors at most need none and are compared as they are, all such lengths in one job.

Rows: vectors that are null, zero, or hold null or non-finite components link with nothing and are
alone. Any other finite vector links, however small or large its components. Rows with equal or
null ids are vectors of their own; a component takes its smallest id that isn't null. An empty
table gives an empty table. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import components, prepare, staged

#: Vectors that codebooks and stopping point are learned from, at most (about).
SAMPLE = 20_000
#: Codes of a half at most; below, that is up to some 67 million vectors, as many as give a cell about ``PER_CELL``
#: vectors. The grid's counts, a row per cell, come to the driver: about 24 MB at most.
CODES, PER_CELL = 1024, 64
BLOCK = 256
RECALL = 0.9995
#: Vectors whose links with all others are measured (about), links that tell enough, and steps up to the exact bound.
QUERIES, LEAST_LINKS, STEPS = 2000, 100, 100
#: Different vectors of a length up to which they are compared without an index.
FEW = 1000
_ROUNDS, _TURNS = 10, 8


def unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by powers of two first, so that no square leaves the range of doubles."""
    x = x.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _codes(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    codes = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(_ROUNDS):
        near = np.concatenate([_squares(x[at : at + 4096], codes).argmin(axis=1) for at in range(0, len(x), 4096)])
        n = np.bincount(near, minlength=len(codes))
        sums = np.zeros_like(codes)
        np.add.at(sums, near, x)
        codes = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], codes)
    return np.unique(codes, axis=0)


def _squares(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(axis=1)[:, None] - 2 * x @ codes.T + (codes**2).sum(axis=1)[None], 0)


@dataclass
class Index:
    """Codebooks of both halves, the distances among their codes, and where a traversal stops."""

    codes: tuple[np.ndarray, np.ndarray]
    apart: tuple[np.ndarray, np.ndarray]
    stop: float

    @classmethod
    def learn(cls, sample: np.ndarray, n: int, cosine: float, seed: int = 42) -> "Index":
        rng = np.random.default_rng(seed)
        x = unit(sample)
        k = int(min(CODES, max(1, np.ceil(np.sqrt(n / PER_CELL)))))
        half = x.shape[1] // 2
        codes = (_codes(x[:, :half], k, rng), _codes(x[:, half:], k, rng))
        apart = tuple(np.sqrt(_squares(c, c)) for c in codes)
        index = cls(codes, apart, 0.0)
        turned = np.repeat(x[rng.permutation(len(x))[:2000]], _TURNS, axis=0)
        aside = rng.standard_normal(turned.shape)
        aside -= (aside * turned).sum(axis=1, keepdims=True) * turned
        norm = np.linalg.norm(aside, axis=1, keepdims=True)
        other = cosine * turned + np.sqrt(1 - cosine**2) * aside / np.where(norm > 0, norm, 1)
        far = sum(b[np.arange(len(b)), c] for b, c in zip(index.bounds(turned), index.homes(other), strict=True))
        index.stop = float(np.quantile(far, RECALL, method="higher"))
        return index

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.codes[0].shape[1]
        return x[:, :cut], x[:, cut:]

    def homes(self, x: np.ndarray) -> list[np.ndarray]:
        return [_squares(h, c).argmin(axis=1) for h, c in zip(self.halves(x), self.codes, strict=True)]

    def bounds(self, x: np.ndarray) -> list[np.ndarray]:
        """For each half and code, the least squared distance to what is nearer to that code than to the own."""
        out = []
        for h, codes, apart in zip(self.halves(x), self.codes, self.apart, strict=True):
            d = _squares(h, codes)
            own = d.argmin(axis=1)
            gap = apart[own]
            step = (d - d[np.arange(len(d)), own][:, None]) / (2 * np.where(gap > 0, gap, 1))
            out.append(step**2)
        return out

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Home cell of each row and the smaller cells that it visits, in the order of the traversal."""
        width = len(self.codes[1])
        one, two = self.bounds(x)
        home = one.argmin(axis=1) * width + two.argmin(axis=1)
        found = []
        for a, b, cell in zip(one, two, home.tolist(), strict=True):
            i, j = np.flatnonzero(a <= self.stop), np.flatnonzero(b <= self.stop)
            far = a[i][:, None] + b[j][None]
            cells = (i[:, None] * width + j[None])[far <= self.stop]
            order = np.argsort(far[far <= self.stop], kind="stable")
            cells = cells[order]
            found.append(cells[cells < cell])
        return home, found


def _vectors(b: pa.RecordBatch) -> np.ndarray:
    v = b.column("embedding")
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)


def _needed(index: Index, cosine: float, ids: np.ndarray, queries: np.ndarray):
    """How many links of each query are met from which step up to the exact bound on."""
    width = len(index.codes[1])

    def placed(x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        bounds = index.bounds(x)
        homes = [b.argmin(axis=1) for b in bounds]
        return bounds, homes, homes[0] * width + homes[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(queries), STEPS + 1), dtype=np.int64)
        q_bounds, q_homes, q_cell = placed(queries)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                x, own = unit(_vectors(b)), b.column("class").to_numpy()
                row, q = np.nonzero((x @ queries.T >= cosine) & (own[:, None] != ids[None]))
                if not len(row):
                    continue
                bounds, homes, cell = placed(x)
                visits = sum(a[row, h[q]] for a, h in zip(bounds, q_homes, strict=True))
                visited = sum(a[q, h[row]] for a, h in zip(q_bounds, homes, strict=True))
                far = np.where(cell[row] > q_cell[q], visits, visited)
                step = np.ceil(far / max(2 - 2 * cosine, 1e-12) * STEPS).astype(np.int64)
                np.add.at(total, (q, np.minimum(step, STEPS)), 1)
        q, step = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(step), pa.array(total[q, step])], names=["query", "step", "n"])

    return run


def raise_stop(index: Index, classes: DataFrame, n: int, cosine: float) -> None:
    """Raise where a traversal stops to what true links need, over all links and in the mean of the queries."""
    if len(index.codes[0]) * len(index.codes[1]) == 1:
        return
    drawn = classes if n <= QUERIES else classes.where(F.pmod(F.xxhash64("class", F.lit(2)), F.lit(n)) < QUERIES)
    drawn = drawn.orderBy("class").select("class", "embedding").toPandas()
    exact = max(2 - 2 * cosine, 1e-12) * (1 + 1e-9)
    steps = []
    if len(drawn):
        needed = _needed(index, cosine, drawn["class"].to_numpy(), unit(np.stack(drawn["embedding"].to_list())))
        links = classes.mapInArrow(needed, "query long, step long, n long").groupBy("query", "step").agg(F.sum("n").alias("n"))
        share = F.col("n") / F.sum("n").over(Window.partitionBy("query"))
        steps = links.withColumn("share", share).groupBy("step").agg(F.sum("n").alias("n"), F.sum("share").alias("share")).orderBy("step").collect()
    if sum(r["n"] for r in steps) < LEAST_LINKS:
        index.stop = exact
        return
    for weight in ("n", "share"):
        met = np.cumsum([r[weight] for r in steps])
        at = steps[int(np.searchsorted(met, RECALL * met[-1]))]["step"]
        index.stop = max(index.stop, at / STEPS * exact)


def _cells(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = np.zeros(len(index.codes[0]) * len(index.codes[1]), dtype=np.int64)
        visitors = members.copy()
        for b in batches:
            if b.num_rows:
                home, visits = index.visits(unit(_vectors(b)))
                members += np.bincount(home, minlength=len(members))
                visitors += np.bincount(np.concatenate([home, *visits]), minlength=len(members))
        seen = np.flatnonzero(visitors)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(members[seen]), pa.array(visitors[seen])], names=["cell", "members", "visitors"])

    return run


def _dealt(index: Index, members: np.ndarray, visitors: np.ndarray):
    """Rows for (cell, member block, visitor block): role 0 a member, 1 a member as its own cell's visitor, 2 a visitor."""
    member_blocks, visitor_blocks = np.maximum(1, -(-members // BLOCK)), np.maximum(1, -(-visitors // BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            home, visits = index.visits(unit(_vectors(b)))
            own = b.column("deal").to_numpy()
            visits = [v[members[v] > 0] for v in visits]  # nothing to meet in an empty cell
            n = np.array([len(v) for v in visits])
            row = np.concatenate([np.arange(len(home)), np.arange(len(home)), np.repeat(np.arange(len(home)), n)])
            cell = np.concatenate([home, home, *visits]).astype(np.int64)
            role = np.concatenate([np.zeros(len(home)), np.ones(len(home)), np.full(int(n.sum()), 2)]).astype(np.int64)
            times = np.where(role == 0, visitor_blocks[cell], member_blocks[cell])
            k = np.repeat(np.arange(len(row)), times)
            other = np.arange(len(k)) - np.repeat(np.cumsum(times) - times, times)
            mine = np.where(role == 0, own[row] % member_blocks[cell], own[row] % visitor_blocks[cell])[k]
            member = np.where(role[k] == 0, mine, other)
            visitor = np.where(role[k] == 0, other, mine)
            for at in range(0, len(k), 4096):
                s = slice(at, at + 4096)
                taken = b.select(["class", "size", "embedding"]).take(pa.array(row[k[s]]))
                columns = [pa.array(cell[k[s]]), pa.array(member[s]), pa.array(visitor[s]), pa.array(role[k[s]]), *taken.columns]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "member", "visitor", "role", "class", "size", "embedding"])

    return run


def _few(cosine: float):
    """All vectors of a length as members and as visitors of one cell."""
    verified = _verified(cosine)

    def run(rows: pa.Table) -> pa.Table:
        n = rows.num_rows
        return verified(pa.concat_tables([rows, rows]).append_column("role", pa.array(np.repeat([0, 1], n))))

    return run


def _verified(cosine: float):
    def run(unit_: pa.Table) -> pa.Table:
        role = unit_["role"].to_numpy()
        ids, sizes = unit_["class"].to_numpy(), unit_["size"].to_numpy()
        v = unit_["embedding"].combine_chunks()
        x = unit(v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1))
        a, b = role == 0, role > 0
        hit = (x[a] @ x[b].T >= cosine) & (ids[a][:, None] != ids[b][None])
        outside = role[b] == 2
        n = np.concatenate([hit[:, outside] @ sizes[b][outside], sizes[a] @ hit])
        ids_a, ids_b = ids[a], ids[b]
        label_a, label_b, most = ids_a.copy(), ids_b.copy(), np.iinfo(np.int64).max
        if hit.any():
            while True:
                new_b = np.minimum(label_b, np.where(hit, label_a[:, None], most).min(axis=0))
                new_a = np.minimum(label_a, np.where(hit, new_b[None], most).min(axis=1))
                if (new_a == label_a).all() and (new_b == label_b).all():
                    break
                label_a, label_b = new_a, new_b
        out = pa.table({"class": np.concatenate([ids_a, ids_b]), "n": n.astype(np.int64), "root": np.concatenate([label_a, label_b])})
        return out.filter(pa.array((out["n"].to_numpy() > 0) | (out["root"].to_numpy() != out["class"].to_numpy())))

    return run


def _indexed(classes: DataFrame, n: int, cosine: float) -> DataFrame:
    """class, n, root: what block pairs of the index link among the ``n`` classes of one length."""
    drawn = classes if n <= SAMPLE else classes.where(F.pmod(F.xxhash64("class"), F.lit(n)) < SAMPLE)
    sample = drawn.orderBy("class").select("embedding").toPandas()["embedding"]
    index = Index.learn(np.stack(sample.to_list()), n, cosine)
    raise_stop(index, classes, n, cosine)
    dealt = classes.withColumn("deal", F.shiftrightunsigned(F.xxhash64("class", F.lit(1)), 1))
    # One row for each cell of the grid at most.
    cells = dealt.mapInArrow(_cells(index), "cell long, members long, visitors long").groupBy("cell").agg(F.sum("members").alias("members"), F.sum("visitors").alias("visitors")).toPandas()
    members = np.zeros(len(index.codes[0]) * len(index.codes[1]), dtype=np.int64)
    visitors = members.copy()
    members[cells["cell"].to_numpy(dtype=np.int64)] = cells["members"].to_numpy(dtype=np.int64)
    visitors[cells["cell"].to_numpy(dtype=np.int64)] = cells["visitors"].to_numpy(dtype=np.int64)
    kind = dict(classes.dtypes)["embedding"]
    pairs = dealt.mapInArrow(_dealt(index, members, visitors), f"cell long, member long, visitor long, role long, class long, size long, embedding {kind}")
    return pairs.groupBy("cell", "member", "visitor").applyInArrow(_verified(cosine), "class long, n long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept: a row per vector."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    linkable = F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("linkable", F.coalesce(linkable, F.lit(False)))
    # A class is a distinct vector, named by a running number: ids may be null or repeat.
    classes = rows.where("linkable").groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("size"))
    classes = staged(classes.withColumns({"class": F.monotonically_increasing_id(), "length": F.size("embedding")}), "classes")
    alone = F.struct(F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    lengths = {r["length"]: r["count"] for r in classes.groupBy("length").count().where("count > 1").collect()}  # a row per length
    if not classes.count():
        return _result(rows.withColumn("x", alone))
    small = classes.where(F.col("length").isin([d for d, n in lengths.items() if n <= FEW]))
    links = small.select("length", "class", "size", "embedding").groupBy("length").applyInArrow(_few(cosine), "class long, n long, root long")
    for d, n in lengths.items():
        if n > FEW:
            links = links.unionByName(_indexed(classes.where(F.col("length") == d), n, cosine))
    found = staged(links, "vector-links")
    counts = found.groupBy("class").agg(F.sum("n").alias("n"))
    reached = components(found.select(F.col("class").alias("u"), F.col("root").alias("v")))
    classes = classes.join(counts, "class", "left").join(reached, classes["class"] == reached["node"], "left")
    classes = classes.select("embedding", "first", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "class").alias("component"))
    smallest = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = classes.join(smallest, "component").select("embedding", F.struct("n_links", "component_id").alias("x"))
    linked = rows.where("linkable").join(classes, "embedding").select("vec_id", "x")
    return _result(linked.unionByName(rows.where("NOT linkable").select("vec_id", alone.alias("x"))))


def _result(rows: DataFrame) -> DataFrame:
    return rows.select("vec_id", "x.n_links", "x.component_id", F.col("vec_id").eqNullSafe(F.col("x.component_id")).alias("kept"))
