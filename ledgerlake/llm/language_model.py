"""Log probabilities of whole texts under a trigram model of the corpus, kept in Elias-Fano tries.

The model is interpolated absolute discounting over two words of history; its unigrams are the
add-one estimates of the base score, so every word has a probability and those of one history sum
to one. N-grams are not pruned: the tries grow with the corpus.

1. Texts become batches of word codes, written once. A batch gives its distinct words; their counts
   over the training documents of all batches and a number for each word come back to the batches
   that hold them, and so do the counts of word pairs whose first word is frequent. A word of more than ``HOT``
   occurrences is that frequent in some batch, which tells which words to count after. Of pairs more frequent
   than ``HOT`` the counts of what follows come back in the same way. No vocabulary is ever in one place; the
   frequent words and pairs, one in a million tokens or so, are known to all tasks.
2. Each batch sends its triples (two words of history, next word), once for each document that holds
   them, packed in one block per shard. The shard is that of the middle word, so all that a history
   needs is together. A middle word more frequent than ``HOT`` is split by the word before it,
   and where the pair is as frequent too, by document; the parts take their counts from step 1, which are those of
   the whole corpus. So no word or pair of words fills a shard, and none is learnt from a part of the texts.
3. For each shard the trie of its training triples is built in one memory map (see ``elias_fano``),
   and all triples of its blocks are looked up. A task goes through a lot of shards, one trie at a time;
   what goes on is one sum per document and lot. Batches, shards and lots hold a set amount of
   text; there are more of them when the input grows.
4. Sums are added per document, beside the base score that step 2 found.

Rows: a null text is empty, which is one token, the end. ``held_out`` that is null counts as false. Rows
with equal or null ids keep a row each. An empty table gives an empty table; without a training
document all counts are 0. Texts are never split: a batch grows with its longest text. Only the
named columns are read.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare, staged
from ledgerlake.llm.elias_fano import Trie, firsts, totals

#: Text of a batch, in bytes.
BATCH_BYTES = 16 << 20
#: Bytes of batches that a writer or reader holds at once; a larger row is alone.
ROW_GROUP = 16 << 20
#: Tokens that a shard holds on average, at most: what one trie is built of.
SHARD_TOKENS = 1_200_000
#: Tokens of the shards that one task goes through, one after the other; and how many such lots there are at least.
LOT_TOKENS = 16_000_000
LOTS = 24
#: Training occurrences of a word or pair beyond which its histories are split.
HOT = 1_000_000
DISCOUNT = 0.75
BEGIN, END = 0, 1


def _zip(a: np.ndarray) -> bytes:
    """Whole numbers of 32 bits: as many bytes of each as the largest needs, side by side by significance, compressed."""
    width = (int(a.max(initial=0)).bit_length() + 7) // 8
    planes = b"".join((a >> 8 * k).astype(np.uint8).tobytes() for k in range(width))
    return len(a).to_bytes(8, "little") + bytes([width]) + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def _unzip(raw: bytes) -> np.ndarray:
    n, width = int.from_bytes(raw[:8], "little"), raw[8]
    out = np.zeros(n, dtype=np.int64)
    if n and width:
        planes = np.frombuffer(pa.decompress(raw[9:], width * n, codec="zstd", asbytes=True), np.uint8).reshape(width, n)
        for k in range(width):
            out |= planes[k].astype(np.int64) << 8 * k
    return out


def _bundle(arrays: list[np.ndarray]) -> bytes:
    parts = [_zip(a) for a in arrays]
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _unbundle(raw: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(raw):
        size = int.from_bytes(raw[at : at + 8], "little")
        out.append(_unzip(raw[at + 8 : at + 8 + size]))
        at += 8 + size
    return out


# ------------------------------------------------------------------ 1. batches of word codes

def _coded(held: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Codes of all tokens, tokens per text, the words of codes from 2 on, training count per code."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = words.flatten().dictionary_encode()
    found = coded.indices.to_numpy().astype(np.int64)
    store = coded.dictionary.cast(pa.large_binary()).to_pylist()
    bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
    blank = store.index(b"") if b"" in store else -1  # white space at the ends of a text splits off nothing
    real = found != blank
    per_text = np.diff(np.concatenate([[0], np.cumsum(real)])[bounds])
    found = found[real]
    # Frequent words get small codes, which compress well.
    seen = np.bincount(found, minlength=len(store))
    order = np.argsort(-seen, kind="stable")[: int((seen > 0).sum())]
    code_of = np.zeros(len(store), dtype=np.int64)
    code_of[order] = np.arange(2, len(order) + 2)
    ends = np.cumsum(per_text)
    codes = np.insert(code_of[found], ends, END)
    n = per_text + 1
    counts = np.bincount(codes[np.repeat(~held, n)], minlength=len(order) + 2)
    return codes, n, [store[i] for i in order], counts


def _batches(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        some: list[pa.RecordBatch] = []

        def batch() -> pa.RecordBatch:
            nonlocal at, some
            rows = pa.Table.from_batches(some).combine_chunks()
            held = rows.column("held_out").to_numpy()
            codes, n, words, counts = _coded(held, rows.column("text").combine_chunks())
            one = lambda name: pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows.column(name).combine_chunks())
            columns = [
                pa.array([(part << 32) | at]), one("doc_id"), one("held_out"), one("spread"),
                pa.array([int(n.sum())]), pa.array([_zip(n)], pa.binary()), pa.array([_zip(codes)], pa.binary()),
                pa.array([pa.compress(b" ".join(words), codec="zstd", asbytes=True)], pa.binary()), pa.array([sum(map(len, words)) + max(0, len(words) - 1)]),
                pa.array([_zip(counts)], pa.binary()),
            ]
            at, some = at + 1, []
            return pa.RecordBatch.from_arrays(columns, names=["batch", "ids", "held", "spread", "tokens", "n", "codes", "words", "words_size", "counts"])

        size = 0
        for b in batches:
            for k in range(0, b.num_rows, 64):
                piece = b.slice(k, 64)
                some.append(piece)
                size += pc.sum(pc.fill_null(pc.binary_length(piece.column("text")), 0)).as_py()
                if size >= limit:
                    yield batch()
                    size = 0
        if some:
            yield batch()

    return run


def _listed(packed: bytes, size: int) -> list[bytes]:
    """The words of a batch by code from 1 on; the end is the empty word."""
    raw = pa.decompress(packed, size, codec="zstd", asbytes=True)
    return [b"", *(raw.split(b" ") if size else [])]


def _frequent(n_tokens: int, limit: int):
    """Words that are as frequent in a batch as ``limit`` occurrences are in the corpus: all that occur more often are among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for packed, size, counts in zip(*(b.column(c).to_pylist() for c in ("words", "words_size", "counts")), strict=True):
                n = _unzip(counts)[1:]
                words = _listed(packed, size)
                most = np.flatnonzero(n > n.sum() * (limit / n_tokens) * (1 - 1e-9))
                yield pa.RecordBatch.from_arrays([pa.array([words[k] for k in most], pa.binary()).cast(pa.string())], names=["word"])

    return run


def _before(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The code before each."""
    out = np.concatenate([[BEGIN], codes[:-1]])
    out[starts] = BEGIN
    return out


def _after(codes: np.ndarray, n: np.ndarray, held: np.ndarray, place: np.ndarray, size: int, pairs: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """The distinct (word code, history) of a batch, sorted, with their times in training, and for each token its
    number among them or -1. Histories are the places below ``size`` that codes have, or ``pairs`` of these (a * size + b)."""
    starts = np.cumsum(n) - n
    w2 = _before(codes, starts)
    history = place[w2]
    if pairs is not None:
        w1 = _before(w2, starts)
        both = np.where((history >= 0) & (place[w1] >= 0), place[w1] * size + history, -1)
        at = np.minimum(np.searchsorted(pairs, both), len(pairs) - 1)
        history, size = np.where(pairs[at] == both, at, -1), len(pairs)
        del w1, both, at
    del w2
    own = np.flatnonzero(history >= 0)
    keys, which = np.unique(codes[own] * size + history[own], return_inverse=True)
    times = np.bincount(which, np.repeat(~held, n)[own], len(keys)).astype(np.int64)
    token = np.full(len(codes), -1, dtype=np.int32)
    token[own] = which
    return keys // size, keys % size, times, token


#: An entry of ``after`` is a history and a count below this.
_COUNT = 1 << 40


def _words(hot: list[str], pairs: np.ndarray | None = None):
    """A row per batch and word: its code, training count and counts after ``hot`` words, or after ``pairs`` of these
    (then only for words that have such counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(hot, pa.string())
        for b in batches:
            columns = [c for c in ("batch", "words", "words_size", "counts", "held", "n", "codes") if c in b.schema.names]
            for batch, packed, size, counts, *tokens in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
                words = pa.array(_listed(packed, size), pa.binary()).cast(pa.string())
                n, codes, offsets, after = _unzip(counts)[1:], np.arange(1, len(words) + 1, dtype=np.int32), np.zeros(len(words) + 1, dtype=np.int32), np.zeros(0, dtype=np.int64)
                if hot:
                    place = _places(pc.index_in(words, known).fill_null(-1).to_numpy(zero_copy_only=False))
                    held, lengths, text = np.array(tokens[0], dtype=bool), _unzip(tokens[1]), _unzip(tokens[2])
                    code, history, times, _ = _after(text, lengths, held, place, len(hot), pairs)
                    offsets, after = np.searchsorted(code, np.arange(1, len(words) + 2)).astype(np.int32), history * _COUNT + times
                    if pairs is not None:
                        some = np.flatnonzero(np.diff(offsets))
                        words, n, codes, offsets = words.take(pa.array(some)), n[some], codes[some], np.append(offsets[some], len(after)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [words, pa.array(np.full(len(words), batch)), pa.array(codes), pa.array(n), pa.ListArray.from_arrays(pa.array(offsets), pa.array(after))],
                    names=["word", "batch", "code", "n", "after"],
                )

    return run


def _places(of_words: np.ndarray) -> np.ndarray:
    """Places by code, of those from 1 on; where a history begins stands for the end, which is as frequent."""
    return np.concatenate([of_words[:1], of_words]).astype(np.int64)


def _numbered(hot: list[str], size: int, limit: int):
    """Rows sorted by word: each word gets a number within its part and its count over all batches, also after each of
    ``size`` histories; a packed row per batch goes back. ``hot`` words come with their numbers, histories with how many
    words follow, and those of more than ``limit`` occurrences together with a hot word as pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n_words, last = TaskContext.get().partitionId(), 0, None
        known = pa.array(hot, pa.string())
        rows: list[list[np.ndarray]] = []
        for b in batches:
            if not b.num_rows:
                continue
            word = b.column("word")
            new = np.concatenate([[word[0].as_py() != last], pc.not_equal(word.slice(1), word.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)])
            after = b.column("after")
            rows.append([
                n_words - 1 + np.cumsum(new), *(b.column(c).to_numpy() for c in ("batch", "code", "n")), np.diff(after.offsets.to_numpy()),
                after.flatten().to_numpy(), pc.index_in(word, known).fill_null(-1).to_numpy(zero_copy_only=False),
            ])
            n_words, last = n_words + int(new.sum()), word[b.num_rows - 1].as_py()
        if not rows:
            return
        place, batch, code, n, times, after, known_as = (np.concatenate(c) for c in zip(*rows, strict=True))
        del rows
        count = np.bincount(place, n, n_words).astype(np.int64)
        which = np.flatnonzero(known_as >= 0)
        which = which[firsts(place[which])]
        words = [[int(k), int(p), int(count[p])] for k, p in zip(known_as[which], place[which], strict=True)]
        # Counts after histories.
        kinds, pairs, of_batch = np.zeros(size, dtype=np.int64), [], np.repeat(batch, times)
        if size:
            keys, entry = np.unique(np.repeat(place, times) * size + after // _COUNT, return_inverse=True)
            total = np.bincount(entry, after % _COUNT, len(keys)).astype(np.int64)
            kinds = np.bincount(keys[total > 0] % size, minlength=size)
            hot_place = np.full(n_words, -1)
            hot_place[place[which]] = known_as[which]
            much = np.flatnonzero(total > limit)
            pairs = [[int(keys[k] % size), int(hot_place[keys[k] // size]), int(total[k])] for k in much]
            by = np.argsort(of_batch, kind="stable")
            after, of_batch = total[entry[by]], of_batch[by]
            del keys, entry
        by = np.argsort(batch, kind="stable")
        place, batch, code = place[by], batch[by], code[by]
        cuts = firsts(batch)
        ends = np.append(cuts[1:], len(batch))
        own = np.searchsorted(of_batch, batch[cuts]), np.searchsorted(of_batch, batch[cuts], side="right")
        packed = [_bundle([np.diff(place[a:e], prepend=0), code[a:e], *_halves(count[place[a:e]]), after[x:y]]) for a, e, x, y in zip(cuts, ends, *own, strict=True)]
        none = [0] * (len(cuts) - 1)
        nil = [[]] * (len(cuts) - 1)
        long, longs = pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(batch[cuts]), pa.array(np.full(len(cuts), part)), pa.array(packed, pa.binary()), pa.array([int(count.sum()), *none]), pa.array([int((count > 0).sum()), *none]),
                pa.array([words, *nil], longs), pa.array([kinds.tolist(), *nil], long), pa.array([pairs, *nil], longs),
            ],
            names=["batch", "part", "words", "n_train", "distinct", "hot", "kinds", "pairs"],
        )

    return run


def _gaps(a: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Differences of numbers that increase within runs; a run's first number as it is."""
    out = np.diff(a, prepend=0)
    out[first] = a[first]
    return out


def _ungapped(gaps: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.cumsum(gaps)
    return total - np.repeat(total[first] - gaps[first], np.diff(np.append(first, len(gaps))))


def _halves(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return a & 0xFFFFFFFF, a >> 32


def _id(place: np.ndarray, part: np.ndarray | int, parts: int) -> np.ndarray:
    """The number of a word among those of all parts; from 2 on, below are history's beginnings."""
    return 2 + place * parts + part


def _answered(answers: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Id and training count of each word code of a batch."""
    codes, ids, counts = [np.zeros(1, dtype=np.int64)], [np.zeros(1, dtype=np.int64)], [np.zeros(1, dtype=np.int64)]
    for part, packed in zip(answers.column("part").to_pylist(), answers.column("words").to_pylist(), strict=True):
        gaps, code, low, high, _ = _unbundle(packed)
        codes.append(code)
        ids.append(_id(np.cumsum(gaps), part, parts))
        counts.append(low | (high << 32))
    by = np.concatenate(codes)
    out = np.zeros(len(by), dtype=np.int64), np.zeros(len(by), dtype=np.int64)
    out[0][by], out[1][by] = np.concatenate(ids), np.concatenate(counts)
    return out


def _counted(answers: pa.Table, code: np.ndarray, size: int) -> np.ndarray:
    """Counts over all batches of a batch's (word code, history), sorted by ``code``, of ``size`` codes."""
    out, start = np.zeros(len(code), dtype=np.int64), np.searchsorted(code, np.arange(size + 1))
    for packed in answers.column("words").to_pylist():
        _, some, _, _, counts = _unbundle(packed)
        times = start[some + 1] - start[some]
        out[np.repeat(start[some] - (np.cumsum(times) - times), times) + np.arange(times.sum())] = counts
    return out


# ------------------------------------------------------------------ 2. triples to shards

def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread number of 64 bits for each number."""
    x = x.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _shard_of(id1: np.ndarray, id2: np.ndarray, c1: np.ndarray, c2: np.ndarray, spread: np.ndarray, shards: int, limit: int = HOT) -> np.ndarray:
    """Shard of each history: of the middle word ``id2``, and of its part where the word (``c2`` times) or the pair (``c1`` times) is hot."""
    part = np.zeros(len(id2), dtype=np.uint64)
    hot = np.flatnonzero(c2 > limit)
    if len(hot):
        parts = 1 + c2[hot] // limit
        both = 1 + np.minimum(c1[hot], c2[hot]) // limit
        by_word, by_doc = _mixed(id1[hot]) % parts.astype(np.uint64), _mixed(spread[hot]) % both.astype(np.uint64)
        part[hot] = np.uint64(31) * by_word + np.uint64(1009) * by_doc
    return (_mixed(_mixed(id2) + part) % np.uint64(shards)).astype(np.int32)


def _shards(ids: np.ndarray, counts: np.ndarray, w1: np.ndarray, w2: np.ndarray, both: np.ndarray | None, spread: np.ndarray, doc: np.ndarray, shards: int, limit: int) -> np.ndarray:
    """The same for tokens: one lookup a word where it isn't hot. ``both`` are the occurrences of hot pairs, else 0."""
    none = np.zeros(len(ids), dtype=np.int64)
    out = _shard_of(none, ids, none, np.minimum(counts, limit), none, shards, limit)[w2]
    hot = np.flatnonzero((counts > limit)[w2])
    if len(hot):
        a, b = w1[hot], w2[hot]
        c1 = np.zeros(len(hot), dtype=np.int64) if both is None else both[hot]
        out[hot] = _shard_of(ids[a], ids[b], c1, counts[b], spread[doc[hot]], shards, limit)
    return out


class _Hot(NamedTuple):
    """Frequent words: their ids in order and the place of each; by place, how many words follow. Hot pairs of places
    (a * words + b) in order: occurrences, and how many words follow."""

    ids: np.ndarray
    places: np.ndarray
    kinds: np.ndarray
    pairs: np.ndarray
    pair_n: np.ndarray
    pair_kinds: np.ndarray


def _route(n_train: int, distinct: int, parts: int, shards: int, lots: int, limit: int, hot: _Hot, names: list[str]):
    def run(tokens: pa.Table, answers: pa.Table) -> pa.Table:
        rows: list[list] = []
        for t in tokens.to_batches():
            for k in range(t.num_rows):
                rows += block(t.slice(k, 1), answers)
                pa.default_memory_pool().release_unused()  # workers are kept for the stages to come
        return pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds(tokens), strict=True)], names=names)

    def kinds(tokens: pa.Table) -> list[pa.DataType]:
        long = pa.list_(pa.int64())
        return [pa.int64(), pa.int64(), pa.int64(), pa.binary(), tokens.schema.field("ids").type, pa.list_(pa.bool_()), long, long, pa.list_(pa.float64())]

    def block(t: pa.RecordBatch, answers: pa.Table) -> Iterator[list]:
        batch = t.column("batch")[0].as_py()
        held = t.column("held").flatten().to_numpy(zero_copy_only=False)
        spread = t.column("spread").flatten().to_numpy()
        n, codes = _unzip(t.column("n")[0].as_py()), _unzip(t.column("codes")[0].as_py())
        level = answers.column("level").to_numpy()
        words, pairs = answers.filter(pa.array(level == 1)), answers.filter(pa.array(level == 2))
        ids, counts = _answered(words, parts)
        counts[BEGIN] = counts[END]
        doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
        starts = np.cumsum(n) - n
        base = np.log10((counts + 1) / (n_train + distinct + 1))[codes]
        table = [t.column("ids")[0].as_py(), held.tolist(), n.tolist(), np.add.reduceat(counts[codes] > 0, starts, dtype=np.int64).tolist(), np.add.reduceat(base, starts).tolist()]
        yield [-1 - batch, 0, batch, None, *table]
        del base
        # Counts of the corpus for the histories that are split.
        kinds, two, three, both = np.zeros(len(ids), dtype=np.int64), None, None, None
        if len(hot.ids):
            at = np.minimum(np.searchsorted(hot.ids, ids[1:]), len(hot.ids) - 1)
            place = _places(np.where(hot.ids[at] == ids[1:], hot.places[at], -1))
            kinds = np.where((place >= 0) & (counts > limit), hot.kinds[place], 0)
            code, _, _, two = _after(codes, n, held, place, len(hot.ids), None)
            n_two = _counted(words, code, len(ids))
        if len(hot.pairs):
            code, pair, _, three = _after(codes, n, held, place, len(hot.ids), hot.pairs)
            n_three = _counted(pairs, code, len(ids))
            both = np.where(three >= 0, hot.pair_n[pair[three]], 0) if len(pair) else np.zeros(len(codes), dtype=np.int64)
        # From here on a word is its rank among the ids of the batch.
        by_id = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), dtype=np.int32)
        rank[by_id] = np.arange(len(ids), dtype=np.int32)
        ids, counts, w3 = ids[by_id], counts[by_id], rank[codes]
        kinds = kinds[by_id]
        del codes, by_id
        begin = rank[BEGIN]
        w2 = np.concatenate([[begin], w3[:-1]]).astype(np.int32)
        w2[starts] = begin
        w1 = np.concatenate([[begin], w2[:-1]]).astype(np.int32)
        w1[starts] = begin
        shard = _shards(ids, counts, w1, w2, both, spread, doc, shards, limit)
        del both
        size = len(ids)
        key = w2.astype(np.int64) * size + w1
        if size**3 >= 1 << 63:
            key = np.unique(key, return_inverse=True)[1]
        key *= size
        key += w3
        by = np.argsort(key, kind="stable").astype(np.int32)
        del key
        by = by[np.argsort(shard[by].astype(np.uint16 if shards <= 1 << 16 else np.int32), kind="stable")]
        # One after the other, so that each array goes when its order is there.
        shard = shard[by]
        w1 = w1[by]
        w2 = w2[by]
        w3 = w3[by]
        doc = doc[by]
        two = two if two is None else two[by]
        three = three if three is None else three[by]
        del by
        cuts = np.flatnonzero(np.diff(shard)) + 1
        mark = np.zeros(size, dtype=np.int64)
        for a, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)], strict=True):
            x1, x2, x3, d = w1[a:e], w2[a:e], w3[a:e], doc[a:e]
            each = firsts(x2, x1, x3, d)  # a triple in a document
            times = np.diff(np.append(each, e - a))
            x1, x2, x3, d = x1[each], x2[each], x3[each], d[each]
            first = firsts(x2, x1, x3)
            mark[x1], mark[x2], mark[x3] = 1, 1, 1
            own = np.flatnonzero(mark)
            mark[own] = np.arange(len(own))
            docs, d = np.unique(d, return_inverse=True)
            nothing = np.zeros(len(first), dtype=np.int64)
            given = [nothing] * 4
            if two is not None:
                at = two[a:e][each[first]]
                given[0] = np.where((at >= 0) & (kinds[x2[first]] > 0), n_two[at], 0)
            if three is not None and len(pair):
                at = three[a:e][each[first]]
                given[1:] = [np.where(at >= 0, x, 0) for x in (n_three[at], hot.pair_n[pair[at]], hot.pair_kinds[pair[at]])]
            x1, x2, x3 = mark[x1[first]], mark[x2[first]], mark[x3[first]]
            mark[own] = 0
            arrays = [*_halves(np.diff(ids[own], prepend=0)), *_halves(counts[own]), np.diff(docs, prepend=0), held[docs], np.diff(x2, prepend=0), _gaps(x1, firsts(x2)), _gaps(x3, firsts(x2, x1)), np.diff(np.append(first, len(d))), _gaps(d, first), times, kinds[own], *given]
            yield [int(shard[a]) % lots, int(shard[a]), batch, _bundle(arrays), None, None, None, None, None]

    return run


# ------------------------------------------------------------------ 3. tries

def _opened(block: bytes) -> tuple[np.ndarray, ...]:
    """Word ids and their training counts; triples as places among them; their training count; then per
    triple and document: triple, document, times; then how many words follow each word and the counts
    per triple that ``Trie.build`` is given."""
    gaps, gaps_high, counts, counts_high, docs, held, x2, x1, x3, n_docs, d, times, *given = _unbundle(block)
    ids = np.cumsum(gaps | (gaps_high << 32))
    x2 = np.cumsum(x2)
    x1 = _ungapped(x1, firsts(x2))
    x3 = _ungapped(x3, firsts(x2, x1))
    triple = np.repeat(np.arange(len(x2)), n_docs)
    d = _ungapped(d, firsts(triple))
    n = np.bincount(triple, times * (1 - held[d]), len(x2)).astype(np.int64)
    return ids, counts | (counts_high << 32), x1, x2, x3, n, triple, np.cumsum(docs)[d], times, *given


def _built(blocks: list[bytes], total: int) -> Trie:
    """The trie of the training triples of a shard's blocks."""
    parts, given = [], []
    for raw in blocks:
        ids, counts, x1, x2, x3, n, _, _, _, kinds, two, three, of_pair, after_pair = _opened(raw)
        seen = (n > 0) | (two > 0) | (of_pair > 0)
        parts.append((ids, counts, kinds, *(x[seen].astype(np.int32) for x in (x1, x2, x3, n))))
        given.append([x[seen] for x in (two, three, of_pair, after_pair)])
    ids, first = np.unique(np.concatenate([p[0] for p in parts]), return_index=True)
    counts, kinds = (np.concatenate([p[k] for p in parts])[first] for k in (1, 2))
    logs = np.log10((counts + 1) / total)
    place = [np.searchsorted(ids, p[0]).astype(np.int32) for p in parts]
    i1, i2, i3 = (np.concatenate([at[p[k]] for at, p in zip(place, parts, strict=True)]) for k in (3, 4, 5))
    n = np.concatenate([p[6] for p in parts])
    del parts, place
    size = len(ids)
    if size**3 < 1 << 63:
        key = i2.astype(np.int64)
        key *= size
        key += i1
        key *= size
        key += i3
        by = np.argsort(key, kind="stable").astype(np.int32)  # blocks are sorted runs, which a stable sort merges
        del key
    else:
        by = np.lexsort((i3, i1, i2))
    i1, i2, i3, n = i1[by], i2[by], i3[by], n[by]
    one = firsts(i2, i1, i3)
    whole = None
    if kinds.any():
        own = by[one]
        whole = (counts, kinds, *(np.concatenate(g)[own] for g in zip(*given, strict=True)))
    del by, given
    return Trie.build(ids, i1[one], i2[one], i3[one], totals(n, one), logs, DISCOUNT, whole)


def _mapped(trie: Trie) -> Trie:
    """The trie read from a memory map of its bytes."""
    raw = trie.to_bytes()
    levels = mmap.mmap(-1, len(raw))
    levels.write(raw)
    return Trie.open(levels)


def _score(n_train: int, distinct: int, schema: list[str]):
    total = n_train + distinct + 1

    def run(rows: pa.Table) -> pa.Table:
        kinds = [pa.int64(), pa.int64(), pa.float64(), rows.schema.field("ids").type.value_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64()]
        parts: list[list[pa.Array]] = []
        shards: dict[int, list[tuple[int, pa.Scalar]]] = {}
        for k, raw in enumerate(rows.column("block")):
            batch = rows.column("batch")[k].as_py()
            if raw.is_valid:
                shards.setdefault(rows.column("shard")[k].as_py(), []).append((batch, raw))
                continue
            lists = [rows.column(c)[k].values for c in ("ids", "held", "n", "known", "base")]
            m = len(lists[0])
            parts.append([pa.array([batch] * m, pa.int64()), pa.array(range(m), pa.int64()), pa.array([0.0] * m), *lists])
        sums: dict[int, np.ndarray] = {}
        for blocks in shards.values():
            trie = _mapped(_built([raw.as_py() for _, raw in blocks], total))
            for batch, raw in blocks:
                ids, counts, x1, x2, x3, _, triple, doc, times, *_ = _opened(raw.as_py())
                logs = trie.log10(ids, x1, x2, x3, np.log10((counts + 1) / total))
                own = np.bincount(doc, logs[triple] * times)
                before = sums.get(batch, np.zeros(0))
                more = np.zeros(max(len(own), len(before)))
                more[: len(before)] = before
                more[: len(own)] += own
                sums[batch] = more
            del trie
            pa.default_memory_pool().release_unused()
        for batch, own in sums.items():
            docs = np.flatnonzero(own)  # a sum of 0 adds nothing
            parts.append([pa.array(np.full(len(docs), batch)), pa.array(docs), pa.array(own[docs]), *(pa.nulls(len(docs), k) for k in kinds[3:])])
        return pa.Table.from_arrays([pa.chunked_array([p[i] for p in parts], kinds[i]) for i in range(len(kinds))], names=schema)

    return run


def scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row per document.

    The model learns from the documents that aren't ``held_out`` (a condition on ``docs``).
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.xxhash64(F.col(id_col).cast("string")).alias("spread"), F.col(text_col).alias("text"),
    )
    kind = dict(rows.dtypes)["doc_id"]
    schema = f"batch long, ids array<{kind}>, held array<boolean>, spread array<long>, tokens long, n binary, codes binary, words binary, words_size long, counts binary"
    tokens = staged(rows.mapInArrow(_batches(BATCH_BYTES), schema), "lm-tokens", ROW_GROUP, heavy=True)
    n_tokens = tokens.agg(F.sum("tokens")).first()[0] or 0
    lots = max(LOTS, -(-n_tokens // LOT_TOKENS))
    shards = lots * max(1, -(-n_tokens // (SHARD_TOKENS * lots)))

    listed, whole_text = ["batch", "words", "words_size", "counts"], ["held", "n", "codes"]

    def counted(name: str, columns: list[str], hot: list[str], size: int, pairs: np.ndarray | None) -> DataFrame:
        words = tokens.select(*columns).mapInArrow(_words(hot, pairs), "word string, batch long, code int, n long, after array<long>")
        out = "batch long, part long, words binary, n_train long, distinct long, hot array<array<long>>, kinds array<long>, pairs array<array<long>>"
        return staged(words.repartition("word").sortWithinPartitions("word").mapInArrow(_numbered(hot, size, HOT), out), name)

    def followers(answers: DataFrame, size: int) -> np.ndarray:
        out = np.zeros(size, dtype=np.int64)
        for r in answers.select(F.posexplode("kinds")).groupBy("pos").agg(F.sum("col").alias("n")).collect():
            out[r["pos"]] = r["n"]
        return out

    # At most a word in HOT tokens, and a pair in as many, come to the driver, beside words that only some batches hold often.
    hot = []
    if n_tokens > HOT:
        hot = sorted(r[0] for r in tokens.select("words", "words_size", "counts").mapInArrow(_frequent(n_tokens, HOT), "word string").distinct().collect())
    answers = counted("lm-words", [*listed, *(whole_text if hot else [])], hot, len(hot), None)
    # Parts are counted when they are there: their number is the session's and adaptive execution's.
    seen = answers.agg(F.sum("n_train").alias("n"), F.sum("distinct").alias("v"), F.max("part").alias("last")).first()
    n_train, distinct, parts = seen["n"] or 0, seen["v"] or 0, 1 + (seen["last"] or 0)
    none = np.zeros(0, dtype=np.int64)
    known = _Hot(none, none, none, none, none, none)
    back = answers.select("batch", "part", "words", F.lit(1).alias("level"))
    if hot:
        places, numbers, counts, part = np.array([[*r["col"], r["part"]] for r in answers.select("part", F.explode("hot")).collect()]).T
        ids = _id(numbers, part, parts)
        by = np.argsort(ids)
        known = known._replace(ids=ids[by], places=places[by], kinds=followers(answers, len(hot)))
        pairs = {(a * len(hot) + b): n for (a, b, n) in (r[0] for r in answers.select(F.explode("pairs")).collect())}
        if hot[0] == "" and counts[places == 0][0] > HOT:  # a history that begins each text
            pairs[0] = int(counts[places == 0][0])
        if pairs:
            keys = np.array(sorted(pairs), dtype=np.int64)
            triples = counted("lm-pairs", [*listed, *whole_text], hot, len(keys), keys)
            known = known._replace(pairs=keys, pair_n=np.array([pairs[k] for k in keys.tolist()], dtype=np.int64), pair_kinds=followers(triples, len(keys)))
            back = back.unionByName(triples.select("batch", "part", "words", F.lit(2).alias("level")))

    block = f"lot long, shard long, batch long, block binary, ids array<{kind}>, held array<boolean>, n array<long>, known array<long>, base array<double>"
    names = ["lot", "shard", "batch", "block", "ids", "held", "n", "known", "base"]
    wanted = tokens.select("batch", "ids", "held", "spread", "n", "codes")
    routed = wanted.groupBy("batch").cogroup(back.groupBy("batch")).applyInArrow(_route(n_train, distinct, parts, shards, lots, HOT, known, names), block)
    out = ["batch", "doc", "score", "doc_id", "held_out", "n_tokens", "n_known", "base_score"]
    summed = routed.groupBy("lot").applyInArrow(
        _score(n_train, distinct, out),
        f"batch long, doc long, score double, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double",
    )
    row = F.struct("doc_id", "held_out", "n_tokens", "n_known", "base_score")
    whole = summed.groupBy("batch", "doc").agg(F.sum("score").alias("score"), F.first(F.when(F.col("n_tokens").isNotNull(), row), ignorenulls=True).alias("row"))
    return whole.select("row.doc_id", "row.held_out", "row.n_tokens", "row.n_known", F.lit(n_train).cast("long").alias("train_tokens"), "row.base_score", "score")
