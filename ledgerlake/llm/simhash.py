"""SimHash near-duplicates over an inverted index of byte positions.

A fingerprint has eight bytes in eight positions. Fingerprints that differ in two bits at most
share the bytes of at least six positions, the guaranteed minimum of matches, and so both bytes of
at least two of the four pairs of positions. The index lists each distinct fingerprint under every
two of its four pairs (6 keys of 4 bytes). In a list the shared positional bytes of each two
fingerprints are tallied; those with the minimum are retained and their bits verified. A list longer than
``LISTED`` isn't tallied but listed anew by its other positions: of these at least two more bytes are
shared, so that it falls into lists by six bytes, 65,536 at most each, where the tally holds
by itself. What a list links goes on as one edge per fingerprint to the smallest one it reaches
there, not as pairs.

Rows: a null or empty text, or one without a word, has fingerprint 0, linked like any other.
A text with fewer words than a shingle is one shingle. Rows with equal or null ids keep a row
each; a component takes the smallest id that isn't null (none: null). An empty table gives an
empty table. Only the two named columns are read; ``keep_one`` returns all columns of its input.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import components, free_names, prepare, staged

SEED = 42
POSITIONS = 8
#: Positions whose bytes may differ; as many as differing bits can touch.
LEFT_OUT = 2
#: Fingerprints of a list that are tallied at most.
LISTED = 512


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """SimHash of a UTF-8 text's word shingles, repeats included, under XXH64."""
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        texts = iter([b" ".join(words)])
        n = 1
    else:
        texts = map(b" ".join, zip(*(islice(words, k, None) for k in range(shingle)), strict=False))
        n = len(words) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, texts, repeat(SEED)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        some = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.array([fingerprint(t or b"", shingle) for t in b.column("text").cast(pa.binary()).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(prints.view(np.int64))], names=["doc_id", "text_hash", "print"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash (of the text as it is), print (64 bits as a long)."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), f"doc_id {dict(rows.dtypes)['doc_id']}, text_hash long, print long")


def _shared(differing: np.ndarray) -> np.ndarray:
    """Number of equal positional bytes of two fingerprints, from the bits in which they differ."""
    return (np.ascontiguousarray(differing).view(np.uint8).reshape(*differing.shape, POSITIONS) == 0).sum(axis=-1)


def _mask(positions: tuple[int, ...]) -> Column:
    mask = reduce(lambda m, p: m | 0xFF << 8 * p, positions, 0)
    return F.col("print").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


#: The positions of each key of the index: two of the four pairs.
_PAIRS = [tuple(p for pair in two for p in (2 * pair, 2 * pair + 1)) for two in combinations(range(POSITIONS // 2), 2)]


def _keys(ways: list[tuple[int, ...]]) -> Column:
    """(which positions, their bytes) for each way."""
    return F.explode(F.array(*[F.struct(F.lit(k).alias("way"), _mask(p).alias("bytes")) for k, p in enumerate(ways)]))


def _further() -> Column:
    """The same for a list that was too long: its own four positions and two of the others."""
    ways = []
    for own in _PAIRS:
        others = [p for p in range(POSITIONS) if p not in own]
        ways.append(F.array(*[F.struct(F.lit(sum(1 << p for p in own + two)).alias("way"), _mask(own + two).alias("bytes")) for two in combinations(others, 2)]))
    return F.explode(F.element_at(F.array(*ways), F.col("way") + 1))


def _reached(near: np.ndarray) -> np.ndarray:
    """For each row of a table of links, the smallest row that links reach."""
    label = np.arange(len(near))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(near)).min(axis=1))
        if (new == label).all():
            return label
        label = new


def _tallied(bits: int):
    """Lists, sorted by key: links (way -1), and the fingerprints of lists that are too long (their way)."""
    least = POSITIONS - bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray, int]] = []

        def closed(way: int, prints: np.ndarray) -> None:
            prints = np.unique(prints)
            differing = prints[:, None] ^ prints[None, :]
            retained = _shared(differing) >= least
            label = _reached(retained & (np.bitwise_count(differing) <= bits))
            moved = label != np.arange(len(prints))
            out.append((prints[moved], prints[label[moved]], -1))

        def sent() -> pa.RecordBatch:
            u, v = (np.concatenate([x[k] for x in out] or [np.zeros(0, dtype=np.uint64)]) for k in (0, 1))
            way = np.concatenate([np.full(len(x[0]), x[2]) for x in out] or [np.zeros(0, dtype=np.int64)])
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64)), pa.array(way, pa.int32())], names=["u", "v", "way"])

        open_: tuple[tuple[int, int], list[np.ndarray], bool] | None = None  # the key, its fingerprints so far, whether it is too long
        for b in batches:
            way, key, prints = b.column("way").to_numpy(), b.column("bytes").to_numpy(), b.column("print").to_numpy().view(np.uint64)
            starts = np.flatnonzero(np.concatenate([[True], (way[1:] != way[:-1]) | (key[1:] != key[:-1])])) if len(way) else []
            ends = np.append(starts[1:], len(way)) if len(way) else []
            single = np.diff(np.append(starts, len(way))) == 1 if len(way) else []
            for s, e, one in zip(starts, ends, single, strict=True):
                this = (int(way[s]), int(key[s]))
                if open_ and open_[0] != this:
                    if not open_[2] and sum(map(len, open_[1])) > 1:
                        closed(open_[0][0], np.concatenate(open_[1]))
                    open_ = None
                if one and open_ is None and e < len(way):
                    continue  # alone in its list
                _, some, long = open_ or (this, [], False)
                some.append(prints[s:e])
                if long or sum(map(len, some)) > LISTED:
                    for x in some:
                        out.append((x, x, this[0]))
                    some, long = [], True
                open_ = (this, some, long)
            yield sent()
        if open_ and not open_[2]:
            closed(open_[0][0], np.concatenate(open_[1]))
        yield sent()

    return run


def _smallest(prints: np.ndarray, bits: int) -> np.ndarray:
    """For each fingerprint of a list, the smallest one that links of the list reach."""
    label = np.arange(len(prints))
    if len(prints) <= LISTED:
        return _reached(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= bits)
    # the differing bytes side by side: a table of 16 bits, and every way to flip so many of them
    free = np.bitwise_or.reduce(prints ^ prints[0])
    places = [p for p in range(64) if int(free) >> p & 1]
    small = np.zeros(len(prints), dtype=np.int64)
    for k, p in enumerate(places):
        small |= ((prints >> np.uint64(p)) & np.uint64(1)).astype(np.int64) << k
    flips = [sum(1 << p for p in way) for n in range(1, bits + 1) for way in combinations(range(len(places)), n)]
    table = np.full(1 << len(places), len(prints))
    table[small] = label
    while True:
        before = table[small].copy()
        for flip in flips:
            table[small] = np.minimum(table[small], table[small ^ flip])
        if (table[small] == before).all():
            return before


def _links(bits: int):
    def linked(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = np.unique(prints)
        label = _smallest(prints, bits)
        moved = label != np.arange(len(prints))
        return prints[moved], prints[label[moved]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lists arrive sorted by key; the last one of a batch waits for its rest."""
        carry: tuple[np.ndarray, ...] | None = None

        def edges(way: np.ndarray, key: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
            starts = np.flatnonzero(np.concatenate([[True], (way[1:] != way[:-1]) | (key[1:] != key[:-1])]))
            sizes = np.diff(np.append(starts, len(way)))
            two = starts[sizes == 2]
            a, b = np.minimum(prints[two], prints[two + 1]), np.maximum(prints[two], prints[two + 1])
            near = (np.bitwise_count(a ^ b) <= bits) & (a != b)
            us, vs = [b[near]], [a[near]]
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                u, v = linked(prints[s : s + n])
                us.append(u)
                vs.append(v)
            u, v = np.concatenate(us), np.concatenate(vs)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for b in batches:
            if not b.num_rows:
                continue
            rows = [b.column("way").to_numpy(), b.column("bytes").to_numpy(), b.column("print").to_numpy().view(np.uint64)]
            if carry is not None:
                rows = [np.concatenate(x) for x in zip(carry, rows, strict=True)]
            changes = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]))
            cut = int(changes[-1]) + 1 if len(changes) else 0
            if cut:
                yield from edges(*(x[:cut] for x in rows))
            carry = tuple(x[cut:] for x in rows)
        if carry is not None:
            yield from edges(*carry)

    return run


def links(prints: DataFrame, bits: int = 2) -> DataFrame:
    """Edges (u, v) that connect all fingerprints of ``prints`` (print, distinct) within ``bits`` bits."""
    if not 0 <= bits <= LEFT_OUT:
        raise ValueError(f"keys leave {LEFT_OUT} positions out, which covers at most as many differing bits")
    def dealt(rows: DataFrame, keys: Column) -> DataFrame:
        listed = rows.select("print", keys.alias("key")).select(F.col("key.way").alias("way"), F.col("key.bytes").alias("bytes"), "print")
        return listed.repartition("way", "bytes").sortWithinPartitions("way", "bytes")

    found = staged(dealt(prints.select("print"), _keys(_PAIRS)).mapInArrow(_tallied(bits), "u long, v long, way int"), "tallied")
    long = found.where("way >= 0").select(F.col("u").alias("print"), "way")
    return found.where("way < 0").select("u", "v").unionByName(dealt(long, _further()).mapInArrow(_links(bits), "u long, v long"))


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, fingerprint (16 hex digits), component_id, component: a row per document.

    ``component`` names the component even where it has no id that isn't null.
    """
    rows = staged(fingerprints(docs, shingle, id_col, text_col), "prints")
    distinct = staged(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct-prints")
    found = components(links(distinct.select("print"), bits))
    named = distinct.join(found, distinct["print"] == found["node"], "left").select("print", "first", F.coalesce("component", "print").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    # Most fingerprints are alone; components are shuffled again, texts and rows are not.
    named = named.join(smallest, "component").select("print", "component", "component_id")
    hex_ = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return rows.join(named, "print").select("doc_id", "text_hash", hex_.alias("fingerprint"), "component_id", "component")


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: the smallest id (null first), then text hash, then any equal row."""
    found = near_duplicates(docs, shingle, bits, id_col, text_col)
    first = found.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("x")).select("x.*")
    zero = F.lit(0).cast(dict(first.dtypes)["doc_id"])
    keys = free_names(docs.columns, "sim_id", "sim_null", "sim_hash")
    named = lambda id_, hash_: dict(zip(keys, (F.coalesce(id_, zero), id_.isNull(), hash_), strict=True))
    kept = first.select(*[v.alias(k) for k, v in named(F.col("doc_id"), F.col("text_hash")).items()])
    rows = docs.withColumns(named(F.col(id_col), F.xxhash64(text_col)))
    return rows.join(kept, keys, "left_semi").dropDuplicates(keys).select(*[F.col(f"`{c}`") for c in docs.columns])
