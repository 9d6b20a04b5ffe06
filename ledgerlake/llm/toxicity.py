"""Toxicity: boosted trees over dense features of a text, with isotonic calibration.

Features are densities of lexicon words, plain and disguised (digits or signs for letters,
stretched or spaced letters), how near they stand to the second person, and rates of capitals,
punctuation and disguise. The lexicon is a short fixed one plus words and word beginnings that
labelled toxic documents share and others lack, far beyond chance. Lexicon, trees and
calibration learn from at most about ``LABELLED`` labelled documents that are not held out; the
calibration is fitted to scores by trees that haven't seen the document. Language, source, id
and labels are no inputs of a score.

Rows: a null text is an empty text and has a score. Rows with equal or null ids are scored one
by one. Without labels, or with clean ones only, every score is 0. An empty table gives an
empty table. Only the named columns are read; ``clean`` keeps all columns of its input.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare, staged
from ledgerlake.llm.labelled import held_out, sample
from ledgerlake.llm.trees import Trees, fit, isotonic

LABELLED = 20_000
THRESHOLD = 0.3
#: Learned lexicon: so many entries at most, each so many times as common in toxic documents as
#: elsewhere at least, and less likely by chance than this after counting all candidates.
LEARNED, LEAST_LIFT, CHANCE = 200, 4.0, 0.01
#: Lengths of word beginnings that may be entries, besides whole words.
STEMS = (4, 5, 6, 7, 8)
FOLDS = 4
NEAR = 4
#: Distinct words that a worker remembers.
CACHED_WORDS = 200_000
# Insults, and words of the second person, in the languages of the corpus.
INSULTS = (
    "idiot idiots idiotic moron morons moronic stupid dumb dumbass loser losers pathetic worthless trash scum clown "
    "disgusting garbage imbecile fool foolish ugly retard retarded bastard bitch asshole jerk creep filth filthy vermin "
    "hate shut bullshit fuck fucking shit crap crappy dummkopf arschloch trottel abschaum connard salaud crétin imbécile "
    "idiota estúpido estúpida basura"
).split()
SECOND_PERSON = "you your yours yourself youre ur u du dich dir dein deine ihr euch tu toi te ton ta vous votre usted tú ti tus".split()

FEATURES = (
    "plain", "plain_n", "disguised", "disguised_n", "learned", "learned_n", "learned_weight", "spaced_n", "near_second", "second",
    "capitals", "capital_words", "punctuation", "exclaims", "mixed", "stretched", "log_words",
)
_EDGES = ".,;:!?'\"()[]{}<>-_/\\|#*&%^~`+=«»“”‘’…¡¿"
#: Signs at a word's edges that never stand for a letter.
_SILENT = ".,;:?\"'()"
_PLAIN_EDGES = _EDGES.encode()
_LEET = str.maketrans("013457@$!|+€", "oieastasiite")
_REPEATS = re.compile(r"(.)\1+")
_STRETCHED_RUN = re.compile(r"(.)\1\1")
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_NONE, _PLAIN, _LEARNED, _DISGUISED, _SECOND, _LETTER, _MIXED, _STRETCHED = 0, 1, 2, 4, 8, 16, 32, 64


def core(word: bytes) -> str:
    """A word in lower case without punctuation at its edges."""
    return word.decode().lower().strip(_EDGES)


class Lexicon(dict):
    """Word in UTF-8 to its marks; remembers a bounded number of words."""

    def __init__(self, learned: dict[str, float]) -> None:
        super().__init__()
        self.insults, self.second, self.weights = frozenset(INSULTS), frozenset(SECOND_PERSON), learned
        self.all = self.insults | {w for w in learned if not w.endswith("*")}
        self.single = {_REPEATS.sub(r"\1", w): w for w in self.all}

        self.heads = frozenset(w[: STEMS[0]] for w in learned)

    def weight(self, w: str) -> float:
        """The largest weight of the learned entries that a word matches, 0 if there is none."""
        if w[: STEMS[0]] not in self.heads:
            return 0.0
        return max([self.weights.get(w, 0.0), *(self.weights.get(f"{w[:n]}*", 0.0) for n in STEMS if len(w) > n)])

    def __missing__(self, word: bytes) -> int:
        low = word.decode().lower()
        w = low.strip(_EDGES)
        marks = (_PLAIN if w in self.insults else 0) | (_LEARNED if self.weight(w) else 0)
        letters = w.isalpha()
        stretched = _STRETCHED_RUN.search(w) is not None
        if w in self.second:
            marks |= _SECOND
        if letters and len(w) == 1:
            marks |= _LETTER
        if not letters and any(map(str.isalpha, w)):
            marks |= _MIXED
        if stretched:
            marks |= _STRETCHED
        # Letters without a stretch hide nothing; any other sign at their ends may be one more letter.
        searched = stretched or not low.strip(_SILENT).isalpha()
        if not marks & (_PLAIN | _LEARNED) and len(w) > 2 and searched and self.undisguised(low):
            marks |= _DISGUISED
        if len(self) < CACHED_WORDS:
            self[word] = marks
        return marks

    def undisguised(self, word: str) -> bool:
        """Whether it reads as a lexicon word once signs are letters again or dropped, and stretches are short."""
        for w in (word.translate(_LEET), word.strip(_EDGES).translate(_LEET), word):
            w = "".join(c for c in w if c.isalpha())
            if w != word.strip(_EDGES) and w in self.all:
                return True
            if (short := _REPEATS.sub(r"\1", w)) != w and short in self.single and (w not in self.all) and _STRETCHED_RUN.search(w):
                return True
        # one letter hidden behind a sign, as in id*ot
        bare = word.strip(".,;:?!\"'()")
        if 3 < len(bare) < 20 and any(c in "*#_-.@" for c in bare[1:-1]) and sum(not c.isalpha() for c in bare) <= 2:
            shape = re.compile("".join(c if c.isalpha() else "." for c in bare))
            return any(len(x) == len(bare) and shape.fullmatch(x) for x in self.all)
        return False


def features(raw: bytes, lexicon: Lexicon) -> tuple[float, ...]:
    """The features of one whole text in UTF-8, in the order of ``FEATURES``."""
    words = raw.split()
    n = max(1, len(words))
    marks = np.fromiter(map(lexicon.__getitem__, words), dtype=np.int16, count=len(words))
    plain, learned, disguised, second = ((marks & m) > 0 for m in (_PLAIN, _LEARNED, _DISGUISED, _SECOND))
    hit = plain | learned | disguised
    weight = sum(lexicon.weight(core(words[i])) for i in np.flatnonzero(learned))
    near = 0
    if hit.any() and second.any():
        at, you = np.flatnonzero(hit), np.flatnonzero(second)
        k = np.searchsorted(you, at)
        gap = np.minimum(np.abs(you[np.minimum(k, len(you) - 1)] - at), np.abs(you[np.maximum(k - 1, 0)] - at))
        near = int((gap <= NEAR).sum())
    letter = (marks & _LETTER) > 0
    spaced = 0
    if letter.sum() > 3:
        spelled = "".join(core(w) if one else " " for w, one in zip(words, letter.tolist(), strict=True))
        spaced = sum(any(x in run for x in lexicon.all if len(x) > 3) for run in spelled.split() if len(run) > 3)
    joined = b"".join(words)
    size = max(1, len(joined))
    upper, lower = size - len(joined.translate(None, _UPPER)), size - len(joined.translate(None, _LOWER))
    exclaims = raw.count(b"!")
    return (
        plain.sum() / n, plain.sum(), disguised.sum() / n, disguised.sum(), learned.sum() / n, learned.sum(), weight, spaced, near / n, second.sum() / n,
        upper / max(1, upper + lower), sum(map(bytes.isupper, words)) / n, (len(joined) - len(joined.translate(None, _PLAIN_EDGES))) / size,
        exclaims / n, ((marks & _MIXED) > 0).sum() / n, ((marks & _STRETCHED) > 0).sum() / n, np.log1p(len(words)),
    )


def entries(raw: bytes) -> Counter[str]:
    """A text's candidates and how often they occur: its words, and with a star the beginnings of longer ones."""
    found: Counter[str] = Counter()
    for w, n in Counter(map(core, raw.split())).items():
        found[w] += n
        for k in STEMS:
            if len(w) > k:
                found[f"{w[:k]}*"] += n
    return found


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(counts: dict[tuple[str, int], list[int]]) -> pa.RecordBatch:
        clean, toxic = ([c[k] for c in counts.values()] for k in (0, 1))
        word, times = ([k[i] for k in counts] for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(times, pa.int32()), pa.array(clean, pa.int64()), pa.array(toxic, pa.int64())], names=["word", "times", "clean", "toxic"])

    counts: dict[tuple[str, int], list[int]] = {}
    for b in batches:
        for t, y in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("y").to_pylist(), strict=True):
            for w, n in entries(t or b"").items():
                for times in range(1, min(n, 2) + 1):
                    counts.setdefault((w, times), [0, 0])[y > 0] += 1
        if len(counts) > CACHED_WORDS:
            yield rows(counts)
            counts = {}
    yield rows(counts)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        marks = []
        for t in b.column("text").cast(pa.binary()).to_pylist():
            words = (t or b"").lower().split()
            runs = (b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))
            marks.append(min(map(xxhash.xxh64_intdigest, runs)).to_bytes(8, "big"))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(marks, pa.binary())], names=[*b.schema.names, "mark"])


def learned_words(texts: DataFrame) -> dict[str, float]:
    """Entries (of text, y) that toxic documents share and others lack, and their log lifts; ``LEARNED`` at most.

    An entry counts where it occurs, and once more where it occurs twice or more. Near copies would make any word of theirs common, so of texts with the same smallest hash of
    five words one counts. An entry in t toxic and c other documents has the log-likelihood ratio
    of two rates over one; it must exceed what the best of all candidates reaches by chance. Of
    entries where one begins with the other the stronger stays.
    """
    one = texts.mapInArrow(_signed, "text string, y int, mark binary").dropDuplicates(["y", "mark"]).select("text", "y")
    one = staged(one, "toxic-distinct")
    toxic, clean = (max(1, x) for x in one.agg(F.count(F.when(F.col("y") > 0, 1)), F.count(F.when(F.col("y") <= 0, 1))).first())
    words = staged(one.mapInArrow(_words, "word string, times int, clean long, toxic long").groupBy("word", "times").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxic-words")
    least = float(np.log(max(1, words.count()) / CHANCE))
    share = toxic / (toxic + clean)
    t, c = F.col("toxic"), F.col("clean")
    # t * log(t / expected) + c * log(c / expected)
    ratio = t * F.log(t / ((t + c) * share)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0.0)
    lift = (t / toxic) / ((c + 0.5) / clean)
    found = words.where((t > 0) & (F.length("word") > 2) & (lift >= LEAST_LIFT)).where(ratio >= least)
    taken: dict[str, float] = {}
    for r in found.orderBy(F.desc(ratio), F.length("word"), "word", "times").select("word", F.log(lift).alias("weight")).limit(20 * LEARNED).collect():
        w = r["word"].rstrip("*")
        if len(taken) < LEARNED and not any(w.startswith(x.rstrip("*")) or x.startswith(w) for x in taken):
            taken[r["word"]] = r["weight"]
    return taken


def _matrix(batch: pa.RecordBatch, text_col: str, lexicon: Lexicon) -> np.ndarray:
    texts = batch.column(text_col).cast(pa.binary()).to_pylist()
    return np.array([features(t or b"", lexicon) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))


def _measure(learned: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(learned)
        for b in batches:
            rows = pa.array(list(_matrix(b, "text", lexicon)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), rows], names=["doc_id", "y", "features"])

    return run


@dataclass
class Model:
    trees: Trees
    knots: np.ndarray
    values: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.trees.score(x), self.knots, self.values), 0.0, 1.0)


def fit_model(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> Model | None:
    """Trees from all rows, calibrated on scores by trees of the other folds; None without a toxic row."""
    if not y.sum():
        return None
    unseen = np.zeros(len(y))
    for k in range(FOLDS):
        unseen[fold == k] = _trees(x[fold != k], y[fold != k]).score(x[fold == k])
    return Model(_trees(x, y), *isotonic(unseen, y))


def _trees(x: np.ndarray, y: np.ndarray) -> Trees:
    return fit(x, y, trees=40, depth=3, least=2.0, ridge=2.0)


def _scores(model: Model | None, batch: pa.RecordBatch, text_col: str, lexicon: Lexicon) -> np.ndarray:
    if model is None or not batch.num_rows:
        return np.zeros(batch.num_rows)
    return model.score(_matrix(batch, text_col, lexicon))


def _score(learned: dict[str, float], model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(learned)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(_scores(model, b, "text", lexicon))], names=["doc_id", "score"])

    return run


def _clean(learned: dict[str, float], model: Model | None, text_col: str, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(learned)
        for b in batches:
            yield b.filter(pa.array(_scores(model, b, text_col, lexicon) < threshold))

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", rows: int = LABELLED) -> tuple[dict[str, float], Model | None]:
    """The learned lexicon and the model; numbers of about ``rows`` documents reach the driver at most."""
    prepare(docs.sparkSession)
    drawn = F.broadcast(sample(labels, label, rows))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(drawn, "doc_id")
    texts = staged(texts.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "y"), "toxic-labelled")
    learned = learned_words(texts.select("text", "y"))
    got = texts.mapInArrow(_measure(learned), "doc_id string, y int, features array<double>")
    got = got.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(FOLDS))).toPandas()
    if got.empty:
        return learned, None
    got = got.sort_values("doc_id", kind="stable")
    return learned, fit_model(np.stack(got["features"].to_list()), got["y"].to_numpy(dtype=float), got["fold"].to_numpy(dtype=int))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: a row per document."""
    learned, model = train(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(_score(learned, model), f"doc_id {dict(rows.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    learned, model = train(docs, labels, id_col, text_col)
    return docs.mapInArrow(_clean(learned, model, text_col, threshold), docs.schema)
