"""Secret scans: fixed patterns, and character Markov models for what the patterns miss.

Two bigram models over an identifier's characters are compared: one of random strings, one of
ordinary identifiers. Their samples are labelled by the fixed patterns: characters inside a
match teach the first; all other identifiers of all documents the second, but for long runs that
don't read as a word, which are what is to be decided. Counts of both are sums over every document. A run of identifier characters, cut at all matches, is a secret where
its log-likelihood ratio is at least ``LEAST_RATIO`` in all and ``LEAST_PER_CHAR`` a character;
of a run that isn't, each best stretch of ``LEAST_LENGTH`` characters or more that is, by more
than the choice among stretches gives, and that isn't made of words.

Rows: a null text is an empty text without spans. Ids may be null or repeat; each row is
scanned on its own, so ties don't arise. An empty table leaves both models at their uniform
prior, which finds nothing. Whole texts are scanned. Other columns pass through ``redact``
unchanged, whatever their names; ``scan`` returns fixed columns only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare

# The patterns of the base kinds, in their order.
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
_KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_LEAST_VALUE = 6

#: Identifier characters; 0 stands for everything else and for both ends.
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.zeros(256, dtype=np.int16)
_CODE[np.frombuffer(ALPHABET, dtype=np.uint8)] = np.arange(1, len(ALPHABET) + 1)
K = len(ALPHABET) + 1
LEAST_LENGTH = 16
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % LEAST_LENGTH)
_WORD = re.compile(rb"[A-Za-z]?[a-z]+|[A-Z]+|[0-9]+")  # numbers are ordinary, too
_JOINTS = re.compile(rb"[+/_=-]")
LEAST_RATIO, LEAST_PER_CHAR = 16.0, 0.6
#: Weight of the uniform prior in each row of a model, in characters.
PRIOR = 50.0


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the fixed patterns, leftmost and without overlap within a kind."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= _LEAST_VALUE]
    if b"AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _bigrams(text: bytes) -> np.ndarray:
    codes = np.zeros(len(text) + 2, dtype=np.int32)
    codes[1:-1] = _CODE[np.frombuffer(text, dtype=np.uint8)]
    return np.bincount(codes[:-1] * K + codes[1:], minlength=K * K)


def _value(text: bytes, span: tuple[int, int, int]) -> bytes:
    """The secret itself: what an assignment assigns, else the whole match."""
    start, kind, end = span
    return ASSIGN.match(text, start).group(1) if kind == 0 else text[start:end]


def _parts(text: bytes, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of identifier characters, cut at base spans; what is long enough of them. One merged pass over both."""
    taken: list[list[int]] = []  # the union of the spans, which may overlap
    for a, _, b in base:
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    k = 0
    for m in CANDIDATE.finditer(text):
        at, end = m.span()
        while k < len(taken) and taken[k][1] <= at:
            k += 1
        while k < len(taken) and taken[k][0] < end:
            a, b = taken[k]
            if a - at >= LEAST_LENGTH:
                yield at, a
            at = max(at, b)
            if b > end:
                break  # it reaches into the next run, too
            k += 1
        if end - at >= LEAST_LENGTH:
            yield at, end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, K * K), dtype=np.int64)
    for b in batches:
        texts = b.column("text").cast(pa.binary()).to_pylist()
        total[0] += _bigrams(b"\n".join(t or b"" for t in texts))
        for t in texts:
            base = base_spans(t or b"")
            for span in base:
                own = _bigrams(_value(t, span))
                total[1] += own
                total[0] -= own
            for start, end in _parts(t or b"", base):  # undecided, unless it reads as a word
                if not _WORD.fullmatch(t, start, end):
                    total[0] -= _bigrams(t[start:end])
    kind, cell = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(cell), pa.array(total[kind, cell])], names=["kind", "cell", "n"])


def ratios(ordinary: np.ndarray, random: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each pair of characters, random over ordinary, under a uniform prior.

    The random model is half what the matches hold and half uniform: a matched password may be
    a word, and random strings that no pattern knows still are random.
    """
    learned, usual = (np.maximum(n.reshape(K, K).astype(float), 0) for n in (random, ordinary))
    learned[0, 0] = usual[0, 0] = 0
    learned, usual = ((n + PRIOR / K) / (n.sum(axis=1, keepdims=True) + PRIOR) for n in (learned, usual))
    return np.log((learned + 1 / K) / 2) - np.log(usual)


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The ratio of every pair of characters, from all documents; at most 2 * K**2 counts reach the driver."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(_count, "kind long, cell long, n long")
    total = np.zeros((2, K * K), dtype=np.int64)
    for kind, cell, n in rows.groupBy("kind", "cell").agg(F.sum("n")).collect():
        total[kind, cell] = n
    return ratios(*total)


def random_spans(text: bytes, base: list[tuple[int, int, int]], ratio: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs outside all base spans, else their best stretches, that the random model explains far better."""
    out = []
    for start, end in _parts(text, base):
        codes = np.zeros(end - start + 2, dtype=np.int32)
        codes[1:-1] = _CODE[np.frombuffer(text, dtype=np.uint8, count=end - start, offset=start)]
        scores = ratio[codes[:-1], codes[1:]]
        if scores.sum() >= max(LEAST_RATIO, LEAST_PER_CHAR * (end - start)):
            out.append((start, 3, end))
        else:
            for a, b in sorted(_stretches(scores[:-1])):
                a, b = start + a, start + b
                if all(_WORD.fullmatch(w) for w in _JOINTS.split(text[a:b]) if w):
                    continue
                # whole up to the next joints, so that no end of a secret stays; what the span before took isn't walked again
                if out and out[-1][2] > a:
                    a, _, before = out.pop()
                    b = max(b, before)
                else:
                    while a > start and not _JOINTS.match(text, a - 1):
                        a -= 1
                while b < end and not _JOINTS.match(text, b):
                    b += 1
                out.append((a, 3, b))
    return out


def _stretches(scores: np.ndarray) -> list[tuple[int, int]]:
    """The best stretch of a run by what it scores beyond the least a character, and so on beside it.

    By chance a best stretch scores more the longer the run is, by the log of its length; so does the least ratio.
    """
    out, left, least = [], [(0, len(scores))], LEAST_RATIO + float(np.log(max(1, len(scores))))
    while left:
        start, end = left.pop()
        if end - start < LEAST_LENGTH:
            continue
        gain = np.concatenate([[0.0], np.cumsum(scores[start:end] - LEAST_PER_CHAR)])
        before = gain[: len(gain) - LEAST_LENGTH]
        b = int(np.argmax(gain[LEAST_LENGTH:] - np.minimum.accumulate(before))) + LEAST_LENGTH
        a = int(np.argmin(before[: b - LEAST_LENGTH + 1]))
        if gain[b] >= gain[a] and scores[start + a : start + b].sum() >= least:
            out.append((start + a, start + b))
            left += [(start, start + a), (start + b, end)]
    return out


def spans(text: bytes, ratio: np.ndarray) -> list[tuple[int, int, int]]:
    """All spans (start, kind, end) in bytes, by start, then kind."""
    base = base_spans(text)
    return sorted(base + random_spans(text, base, ratio))


def in_code_points(text: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not found or text.isascii():
        return found
    at = np.concatenate([[0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)])
    return [(int(at[a]), k, int(at[b])) for a, k, b in found]


def _scan(ratio: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column("text").cast(pa.binary()).to_pylist():
                rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in in_code_points(t or b"", spans(t or b"", ratio))])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    return run


def scan(docs: DataFrame, ratio: np.ndarray | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its spans (kind, start, end in code points), by start, then kind."""
    prepare(docs.sparkSession)
    ratio = train(docs, text_col) if ratio is None else ratio
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_scan(ratio), f"doc_id {kind}, spans array<struct<kind: string, start: long, end: long>>")


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans and the text of all spans."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != KINDS[3])), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redacted(text: bytes, found: list[tuple[int, int, int]], mark: bytes) -> bytes:
    out, at = [], 0
    for a, _, b in found:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return b"".join([*out, text[at:]])


def _redact(ratio: np.ndarray, text_col: str, length_col: str | None, mark: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(text_col).cast(pa.binary()).to_pylist()
            new, changed = [], []
            for t in texts:
                found = spans(t, ratio) if t else []
                new.append(redacted(t, found, mark) if found else t)
                changed.append(bool(found))
            columns = dict(zip(b.schema.names, b.columns, strict=True))
            columns[text_col] = pa.array(new, pa.binary()).cast(b.column(text_col).type)
            if length_col:
                old = columns[length_col].to_pylist()
                lengths = [len(t.decode()) if c else n for t, c, n in zip(new, changed, old, strict=True)]
                columns[length_col] = pa.array(lengths, columns[length_col].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=b.schema)

    return run


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs``; each text with its spans (overlapping ones as one) replaced by ``mark``."""
    prepare(docs.sparkSession)
    return docs.mapInArrow(_redact(train(docs, text_col), text_col, length_col, mark.encode()), docs.schema)
