"""Quality rules: document statistics, fixed limits, and boosted trees over the statistics.

The trees learn ``labels.quality`` from at most about ``LABELLED`` labelled documents that are
not held out. They are flattened into numpy node arrays and score whole batches. The score
never rises with the shares of symbols, repeated lines, repeated words, capitals and stops.

Rows: a null text has no words, so the fixed limits reject it, as they do an empty one. Rows
with equal or null ids are judged one by one. Without labels, or with labels of one kind only,
no tree is grown and the fixed limits decide alone. An empty table gives an empty table. Only
the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare
from ledgerlake.llm.labelled import sample
from ledgerlake.llm.trees import Trees, fit

LABELLED = 40_000
#: Documents whose estimated probability of being good is below this are dropped.
LEAST_GOOD = 0.5
WINDOW = 8
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "mean_word", "symbols", "dup_lines", "repeat_words", "capitals", "digits", "stops",
    "punctuation", "distinct", "lines", "bars", "longest_word", "letters",
)
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeat_words": -1, "capitals": -1, "stops": -1, "bars": -1}
# The symbols that a contract counts.
SYMBOLS = b"#*$%&|<>"
_UPPER, _LOWER, _DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_PUNCTUATION = b".,;:!?'\"()[]{}-_/\\@^~`+="


def _tally(raw: bytes, chars: bytes) -> int:
    return len(raw) - len(raw.translate(None, chars))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, compared word by word and not by a hash."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    code = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    if len(numbers) == len(words):
        return 0
    span = 1
    while span < window:  # numbers for runs of 1, 2, 4 ... words, each from two numbers of the run before
        step = min(span, window - span)
        pair = code[: len(code) - step] * (int(code.max()) + 1) + code[step:]
        _, code = np.unique(pair, return_inverse=True)
        span += step
    again = np.bincount(code)[code] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((edge.cumsum() > 0).sum())


def statistics(raw: bytes) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The base counts and the features of one whole text in UTF-8."""
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    joined = b"".join(words)
    n, size = len(words), max(1, len(joined))
    base = (n, len(joined.decode()), _tally(raw, SYMBOLS), len(lines) - len(set(lines)), repeated_words(words))
    upper, lower = _tally(joined, _UPPER), _tally(joined, _LOWER)
    features = (
        np.log1p(n), base[1] / max(1, n), base[2] / max(1, n), base[3] / max(1, len(lines)), base[4] / max(1, n), upper / max(1, upper + lower),
        _tally(joined, _DIGITS) / size, raw.count(b"!") / max(1, n), _tally(joined, _PUNCTUATION) / size, len(set(words)) / max(1, n),
        len(lines) / max(1, n), raw.count(b"|") / max(1, n), max(map(len, words), default=0), (upper + lower) / size,
    )
    return base, features


def _columns(batch: pa.RecordBatch) -> tuple[list[pa.Array], np.ndarray]:
    rows = [statistics(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
    base = [pa.array([r[0][i] for r in rows], pa.int64()) for i in range(len(BASE))]
    return base, np.array([r[1] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(list(_columns(b)[1]), pa.list_(pa.float64()))], names=["doc_id", "y", "features"])


def failed() -> Column:
    """The fixed limits: fewer than 20 words, or over 30 % of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", rows: int = LABELLED) -> Trees | None:
    """Trees for a good label; numbers of about ``rows`` documents reach the driver at most."""
    prepare(docs.sparkSession)
    drawn = F.broadcast(sample(labels, label, rows))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(drawn, "doc_id")
    texts = texts.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "y")
    got = texts.mapInArrow(_measure, "doc_id string, y int, features array<double>").toPandas().sort_values("doc_id", kind="stable")
    if got["y"].nunique() < 2:
        return None
    signs = {FEATURES.index(k): s for k, s in MONOTONE.items()}
    return fit(np.stack(got["features"].to_list()), got["y"].to_numpy(dtype=float), monotone=signs)


def _score(model: Trees | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, x = _columns(b)
            good = np.ones(b.num_rows) if model is None else 1 / (1 + np.exp(-model.score(x)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *base, pa.array(good)], names=["doc_id", *BASE, "good"])

    return run


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base counts, good (probability), base_failed, kept: a row per document."""
    model = train(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, " + ", ".join(f"{c} long" for c in BASE) + ", good double"
    scored = rows.mapInArrow(_score(model), schema)
    return scored.withColumn("base_failed", failed()).withColumn("kept", ~F.col("base_failed") & (F.col("good") >= LEAST_GOOD))
