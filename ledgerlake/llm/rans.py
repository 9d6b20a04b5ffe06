"""Token-id files: static range asymmetric numeral system (rANS) over interleaved lanes.

A file set has one frequency table, counted over all documents and shared by all blocks, and
blocks that decode on their own. A block holds whole documents in ascending id order. Its ids
go round-robin to lanes, each an rANS state of 64 bits that gives off 32-bit words. Every
``CHECK_ROWS`` rows a checkpoint keeps the states, the place in the words and the words'
checksum, so the parts of a block decode independently and each part verifies itself.

Rows: a null text is an empty text; empty texts keep their end id. Rows repeat freely and each
is written; equal ids are ordered by a hash of the text; a null id sorts first and is kept. An
empty table gives an empty file set. Only the two named columns are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare, scratch, staged
from ledgerlake.llm.tokens import encoder, gathered

#: A block closes at the document that brings it to so many ids.
BLOCK_IDS = 1 << 20
LANES = 2048
CHECK_ROWS = 128
#: Frequencies add up to 2**BITS, or to more for a vocabulary that needs it.
BITS = 20
_LOW, _WORD = np.uint64(1 << 31), np.uint64(32)
_MAGIC = b"RANS1\0\0\0"
_HEAD = struct.Struct("<8sIIQQIIIIQ")  # magic, table, bits, start, ids, docs, lanes, rows between checkpoints, checkpoints, words


def quantised(tokens: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Frequencies of all ``size`` ids with sum 2**bits: at least 1 where an id occurs."""
    bits = max(BITS, int(size - 1).bit_length() + 2)
    freq = np.zeros(size, dtype=np.int64)
    if len(tokens):
        share = counts.astype(np.float64) * (1 << bits) / counts.sum()
        freq[tokens] = np.maximum(1, np.floor(share)).astype(np.int64)
        for i in np.argsort(-freq, kind="stable"):  # ends soon: the most frequent ids take the difference
            left = (1 << bits) - int(freq.sum())
            if not left:
                break
            freq[i] += max(left, -(int(freq[i]) // 2))
    return freq, bits


class Codec:
    """Encodes and decodes blocks under one table."""

    def __init__(self, freq: np.ndarray, bits: int) -> None:
        self.bits, self.freq = bits, freq.astype(np.uint64)
        self.cum = (np.cumsum(freq) - freq).astype(np.uint64)
        self.table = zlib.crc32(freq.astype("<u4").tobytes())
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots

    def encode(self, ids: np.ndarray, start: int, docs: list[int | None], lengths: list[int]) -> bytes:
        """One block: header, document index, checkpoints, words."""
        n = len(ids)
        lanes = int(min(LANES, max(1, n // 64)))
        rows, bits, up = -(-n // lanes), np.uint64(self.bits), np.uint64(63 - self.bits)
        freq, cum = self.freq[ids], self.cum[ids]
        x = np.full(lanes, _LOW, dtype=np.uint64)
        words: list[np.ndarray] = []
        marks: list[tuple[np.ndarray, int]] = []
        given = 0
        for r in range(rows - 1, -1, -1):
            a, b = r * lanes, min(n, (r + 1) * lanes)
            f, s = freq[a:b], x[: b - a]
            full = np.flatnonzero(s >= (f << up))
            w = s[full]
            words.append(w.astype("<u4"))
            given += len(w)
            s[full] = w >> _WORD
            q = s // f
            s += (q << bits) - q * f + cum[a:b]
            if r % CHECK_ROWS == 0:
                marks.append((x.copy(), given))
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, dtype="<u4")
        marks.reverse()
        places = [given - at for _, at in marks]
        sums = [zlib.crc32(stream[a:b].tobytes()) for a, b in zip(places, [*places[1:], given], strict=True)]
        index = np.array([d or 0 for d in docs], dtype="<i8").tobytes() + np.array([d is None for d in docs], dtype="u1").tobytes() + np.array(lengths, dtype="<u8").tobytes()
        body = zlib.compress(index, 1)
        head = _HEAD.pack(_MAGIC, self.table, self.bits, start, n, len(docs), lanes, CHECK_ROWS, len(marks), given)
        points = np.array(places, dtype="<u8").tobytes() + np.array(sums, dtype="<u4").tobytes()
        states = b"".join(m.astype("<u8").tobytes() for m, _ in marks)
        plain = head + struct.pack("<I", len(body)) + body + points + states
        return plain + struct.pack("<I", zlib.crc32(plain)) + stream.tobytes()

    def open(self, raw: bytes) -> "Block":
        return Block(self, raw)


class Block:
    """A block that is read: ``docs``, ``lengths``, ``start`` and parts that decode one by one."""

    def __init__(self, codec: Codec, raw: bytes) -> None:
        magic, table, bits, self.start, self.n, n_docs, self.lanes, self.every, n_marks, n_words = _HEAD.unpack_from(raw)
        if magic != _MAGIC or table != codec.table or bits != codec.bits:
            raise ValueError("not a block of this table")
        at = _HEAD.size
        (size,) = struct.unpack_from("<I", raw, at)
        index = zlib.decompress(raw[at + 4 : at + 4 + size])
        at += 4 + size
        self.places = np.frombuffer(raw, "<u8", n_marks, at).astype(np.int64)
        self.sums = np.frombuffer(raw, "<u4", n_marks, at + 8 * n_marks)
        at += 12 * n_marks
        self.states = np.frombuffer(raw, "<u8", n_marks * self.lanes, at).reshape(n_marks, self.lanes)
        at += 8 * n_marks * self.lanes
        if struct.unpack_from("<I", raw, at)[0] != zlib.crc32(raw[:at]):
            raise ValueError("the block's head is damaged")
        self.words = np.frombuffer(raw, "<u4", n_words, at + 4)
        null = np.frombuffer(index, "u1", n_docs, 8 * n_docs)
        self.docs = [None if gone else d for d, gone in zip(np.frombuffer(index, "<i8", n_docs).tolist(), null.tolist(), strict=True)]
        self.lengths = np.frombuffer(index, "<u8", n_docs, 9 * n_docs).astype(np.int64)
        self.codec = codec

    def part(self, k: int) -> np.ndarray:
        """Ids from checkpoint ``k`` to the next one; needs nothing that is decoded before."""
        codec, last = self.codec, k + 1 == len(self.places)
        words = self.words[self.places[k] : len(self.words) if last else self.places[k + 1]]
        if zlib.crc32(words.tobytes()) != self.sums[k]:
            raise ValueError(f"the words of part {k} are damaged")
        words, x = words.astype(np.uint64), self.states[k].copy()
        first = k * self.every * self.lanes
        n = min(self.n, (k + 1) * self.every * self.lanes) - first
        bits, mask, at = np.uint64(codec.bits), np.uint64((1 << codec.bits) - 1), 0
        out = np.empty(n, dtype=np.uint32)
        for a in range(0, n, self.lanes):
            s = x[: min(n - a, self.lanes)]
            slot = s & mask
            ids = codec.slots[slot]
            out[a : a + len(s)] = ids
            s[:] = codec.freq[ids] * (s >> bits) + slot - codec.cum[ids]
            low = np.flatnonzero(s < _LOW)
            s[low] = (s[low] << _WORD) | words[at : at + len(low)]
            at += len(low)
        after = np.full(self.lanes, _LOW, dtype=np.uint64) if last else self.states[k + 1]
        if at != len(words) or not np.array_equal(x, after):
            raise ValueError(f"part {k} doesn't end where the next begins")
        return out

    def ids(self) -> np.ndarray:
        parts = [self.part(k) for k in range(len(self.places))]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)


#: Bytes of a row group of staged ids; a writer holds one in memory.
ROW_GROUP = 16 << 20


def _tokenised(path: str, end_id: int):
    """doc_id, tie (of equal ids), n, ids with the end id: a row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        width = enc.dtype.itemsize
        tail = np.array([end_id], dtype=enc.dtype).tobytes()
        for b in gathered(batches, "text"):
            ids, counts = enc.encode(b.column("text"))
            ends = np.cumsum(counts)
            raw = ids.tobytes()
            own = [raw[width * (e - c) : width * e] + tail for c, e in zip(counts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tie"), pa.array(counts + 1), pa.array(own, pa.binary())], names=["doc_id", "tie", "n", "ids"])

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in their order: number in the range, ids before them in it."""
    part, at, place = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        n = b.column("n").to_numpy()
        starts = place + np.cumsum(n) - n
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(np.arange(at, at + len(n))), b.column("doc_id"), pa.array(starts), b.column("n"), b.column("ids")],
            names=["part", "seq", "doc_id", "start", "n", "ids"],
        )
        at, place = at + len(n), place + int(n.sum())


def _counted(width: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column("ids").to_pylist()), width), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    return run


def _blocks(width: str, freq: np.ndarray, bits: int, before: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(freq, bits)
        docs: list[int | None] = []
        raws: list[bytes] = []
        at, size, after = 0, 0, None

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(raws), width)
            lengths = [len(r) // np.dtype(width).itemsize for r in raws]
            return pa.RecordBatch.from_arrays(
                [pa.array([at]), pa.array([len(ids)]), pa.array([len(docs)]), pa.array([codec.encode(ids, at, docs, lengths)], pa.binary())],
                names=["start", "n_ids", "n_docs", "block"],
            )

        for b in batches:
            for part, seq, doc, start, raw in zip(*(b.column(c).to_pylist() for c in ("part", "seq", "doc_id", "start", "ids")), strict=True):
                if docs and ((part, seq) != after or size >= BLOCK_IDS):
                    yield block()
                    docs, raws, size = [], [], 0
                if not docs:
                    at = before[part] + start
                docs.append(doc)
                raws.append(raw)
                size += len(raw) // np.dtype(width).itemsize
                after = (part, seq + 1)
        if docs:
            yield block()

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the file set ``path``: ``table`` (id, freq) and ``blocks`` (start, n_ids, n_docs, block).

    Documents go in ascending id order. Texts are encoded once, where they are read; their ids are
    staged, ranged, and staged in order for the two passes that need them.
    """
    spark = docs.sparkSession
    prepare(spark)
    enc = encoder(tokenizer)
    width, size = enc.dtype.str, enc.size
    if not 0 <= end_id < size:
        raise ValueError("the end id must be an id of the tokenizer")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    # Ids, not texts, go through the range shuffle, whose bounds are sampled from what is staged.
    coded = staged(rows.mapInArrow(_tokenised(tokenizer, end_id), "doc_id long, tie long, n long, ids binary"), "coded", ROW_GROUP)
    order = ["doc_id", "tie"]
    ranged = coded.repartitionByRange(*order).sortWithinPartitions(*order)
    ids = staged(ranged.mapInArrow(_numbered, "part int, seq long, doc_id long, start long, n long, ids binary"), "ids", ROW_GROUP)
    # At most one row for each id of the vocabulary.
    seen = ids.select("ids").mapInArrow(_counted(width, size), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    freq, bits = quantised(seen["id"].to_numpy(dtype=np.int64), seen["n"].to_numpy(dtype=np.int64), size)
    spark.createDataFrame([(i, int(f), bits, size) for i, f in enumerate(freq) if f], "id int, freq long, bits int, size int").coalesce(1).write.parquet(f"{path}/table")
    # One number for each written range: ids of all ranges before it.
    totals = {r["part"]: r["n"] for r in ids.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    before = dict(zip(sorted(totals), np.cumsum([0, *(totals[p] for p in sorted(totals))]).tolist(), strict=False))
    ids.select("part", "seq", "doc_id", "start", "ids").mapInArrow(_blocks(width, freq, bits, before), "start long, n_ids long, n_docs long, block binary").write.option("compression", "none").parquet(f"{path}/blocks")


def _read(freq: np.ndarray, bits: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(freq, bits)
        for b in batches:
            for raw in b.column("block"):
                block = codec.open(raw.as_py())
                data = memoryview(block.ids().astype("<u4").tobytes())
                ends = np.cumsum(block.lengths)
                starts = ends - block.lengths
                own = [data[4 * a : 4 * e] for a, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [pa.array(block.docs, pa.int64()), pa.array(block.start + starts), pa.array(block.lengths), pa.array([zlib.crc32(x) for x in own], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array([bytes(x) for x in own], pa.binary())] if with_ids else []), names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids])

    return run


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of a file set: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids (unsigned 32-bit)."""
    prepare(spark)
    rows = spark.read.schema("id int, freq long, bits int, size int").parquet(f"{path}/table").collect()  # a vocabulary at most
    freq = np.zeros(rows[0]["size"] if rows else 0, dtype=np.int64)
    for r in rows:
        freq[r["id"]] = r["freq"]
    blocks = spark.read.schema("start long, n_ids long, n_docs long, block binary").parquet(f"{path}/blocks").select("block")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return blocks.mapInArrow(_read(freq, rows[0]["bits"] if rows else BITS, with_ids), schema)


def rans_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes the ids of ``docs`` to a new file set in the shared folder and reads it back."""
    path = scratch(docs.sparkSession, "token-files")
    write_ids(docs, path, tokenizer, end_id)
    return read_ids(docs.sparkSession, path)
