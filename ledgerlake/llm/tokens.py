"""Token ids of whole texts, as the ``tokenizers`` library gives them, at the speed of a dictionary.

Texts repeat their words, so a worker encodes each distinct word once and joins the ids. That
is exact for a tokenizer whose pre-tokenizer drops white space and never joins across it, which
``word_bpe`` files say of themselves; ``WordEncoder`` checks the file and otherwise (or for a
text that holds a special token's string) hands the whole text to the library.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of distinct words and their ids that a worker remembers, and what an entry costs besides.
#: Words beyond are encoded anew. A worker keeps them for its next task, which saves two fifths of the work.
CACHE_BYTES, ENTRY_BYTES = 96 << 20, 170
#: Words handed to the library in one call.
CHUNK = 1000
#: Text that is encoded at once; a longer text is encoded alone.
GATHER_BYTES = 4 << 20
_STOPS = b".,;:!?"
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")
_ENCODERS: dict[str, "WordEncoder"] = {}


def encoder(path: str) -> "WordEncoder":
    """The worker's encoder for a tokenizer file; kept between tasks."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class WordEncoder:
    """Encodes lists of UTF-8 texts to little-endian unsigned 16- or 32-bit ids."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        spec = json.loads(self.whole.to_str())
        self.size = max([self.whole.get_vocab_size(with_added_tokens=True), *(t["id"] + 1 for t in spec["added_tokens"])])
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        # Dropped white space, runs of letters as words, lower case, a mark at each word's end.
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and [s["type"] for s in splits] == ["Split", "ByteLevel"]
            and splits[0]["behavior"] == "Removed"
            and splits[0]["invert"]
            and "[\\p{L}]+" in splits[0]["pattern"].get("Regex", "").split("|")
            and not splits[1]["add_prefix_space"]
            and bool(spec["model"].get("end_of_word_suffix"))
        )
        self.special = [t["content"].lower().encode() for t in spec["added_tokens"]]
        if self.by_word:
            suffix = spec["model"]["end_of_word_suffix"]
            self.ends = np.zeros(self.size, dtype=bool)
            for piece, i in spec["model"]["vocab"].items():
                self.ends[i] = piece.endswith(suffix)
            # For words of plain lower-case letters nothing is left to normalise or to split.
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer = None
            self.plain.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )
        self.cache: dict[bytes, bytes] = {}
        self.cached = 0

    def _library(self, texts: list[str]) -> list[bytes]:
        ids = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        ends = [0, *accumulate(len(i) * self.dtype.itemsize for i in ids)]
        raw = np.fromiter(chain.from_iterable(ids), self.dtype, ends[-1] // self.dtype.itemsize).tobytes()
        return [raw[a:e] for a, e in pairwise(ends)]

    def _learn(self, words: list[bytes], into: dict[bytes, bytes]) -> None:
        plain, other, parts = [], [], []
        for w in words:
            core = w.rstrip(_STOPS)
            if core and len(core) < len(w) and core[-1] in _LETTERS:  # a stop never joins the letter before it
                parts.append((w, core, w[len(core):]))
            elif w.isalpha() and w.isascii():
                plain.append(w)
            else:
                other.append(w)
        have = self.cache
        for _, core, tail in parts:
            for x in (core, tail):
                if x not in have and x not in into:
                    into[x] = b""
                    (plain if x.isalpha() and x.isascii() else other).append(x)
        for i in range(0, len(plain), CHUNK):
            some = plain[i : i + CHUNK]
            ids = np.asarray(
                self.plain.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, dtype=self.dtype
            )
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):  # a vocabulary without a mark at some word's end
                into.update(zip(some, self._library([w.decode() for w in some]), strict=True))
                continue
            raw, start = ids.tobytes(), 0
            for w, end in zip(some, (cuts * self.dtype.itemsize).tolist(), strict=True):
                into[w] = raw[start:end]
                start = end
        for i in range(0, len(other), CHUNK):
            some = other[i : i + CHUNK]
            into.update(zip(some, self._library([w.decode() for w in some]), strict=True))
        for w, core, tail in parts:
            into[w] = (into.get(core) or have[core]) + (into.get(tail) or have[tail])

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        found = list(map(self.cache.get, words))
        if None in found:
            fresh: dict[bytes, bytes] = {}
            self._learn([w for w, got in zip(words, found, strict=True) if got is None], fresh)
            self._remember(fresh)
            found = [fresh[w] if got is None else got for w, got in zip(words, found, strict=True)]
        return found

    def _remember(self, fresh: dict[bytes, bytes]) -> None:
        room = CACHE_BYTES - self.cached
        if room <= 0:
            return
        size = sum(map(len, fresh)) + sum(map(len, fresh.values())) + ENTRY_BYTES * len(fresh)
        if size > room:  # the shorter words, which are the ones that repeat
            kept, size = {}, 0
            for w in sorted(fresh, key=len):
                size += len(w) + len(fresh[w]) + ENTRY_BYTES
                if size > room:
                    break
                kept[w] = fresh[w]
            fresh, size = kept, room
        self.cache.update(fresh)
        self.cached += size

    def _joined(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // self.dtype.itemsize
        return np.frombuffer(b"".join(pieces), dtype=self.dtype), counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of each whole text (null: none): all ids in order, and how many each text has."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            return self._joined(self._library(texts.to_pylist()))
        lowered = pc.ascii_lower(texts)
        odd = [pc.match_substring(lowered, s) for s in self.special]
        odd = np.logical_or.reduce([np.asarray(x) for x in odd]) if odd else np.zeros(len(texts), dtype=bool)
        if odd.any():
            lowered = pc.if_else(pa.array(odd), "", lowered)
        words = pc.ascii_split_whitespace(lowered)
        coded = words.flatten().dictionary_encode()
        # Arrow copies each word's ids, as bytes, to its places.
        taken = pa.array(self._ids_of(coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        _, ends, data = taken.buffers()
        ends = np.frombuffer(ends, np.int64, len(taken) + 1, 8 * taken.offset) // self.dtype.itemsize if len(taken) else np.zeros(1, dtype=np.int64)
        ids = np.frombuffer(data, self.dtype, int(ends[-1])).copy() if ends[-1] else np.zeros(0, dtype=self.dtype)
        bounds = ends[words.offsets.to_numpy() - words.offsets[0].as_py()]
        counts = np.diff(bounds)
        if odd.any():
            own = np.split(ids, bounds[1:-1])
            for i in np.flatnonzero(odd):
                own[i] = np.frombuffer(self._library([texts[i].as_py()])[0], dtype=self.dtype)
            ids, counts = np.concatenate(own), np.array([len(x) for x in own], dtype=np.int64)
        return ids, counts


def gathered(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches joined until ``column`` holds a few MB, so that repeated words meet."""
    some: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        some.append(b)
        size += b.column(column).nbytes
        if size >= GATHER_BYTES:
            yield pa.Table.from_batches(some).combine_chunks().to_batches()[0]
            some, size = [], 0
            pa.default_memory_pool().release_unused()
    if sum(b.num_rows for b in some):
        yield pa.Table.from_batches(some).combine_chunks().to_batches()[0]
