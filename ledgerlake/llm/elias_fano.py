"""An n-gram trie in Elias-Fano coded levels, read in place from one buffer (a memory map, a file's bytes).

A sorted list of n integers below u takes about 2 + log2(u / n) bits each: the low bits are packed,
the high bits are unary in a bit vector with running counts of its ones. All lookups are numpy
operations on whole arrays of queries.

The trie is for two words of history. Its levels are ``words`` (the sorted ids), ``after`` (for each
word the words seen after it), ``before`` (for each word the words seen before it) and ``third`` (for
each word and the word before it, what came next). A child is stored relative to its context: in
``third`` as its position among the words after the middle word, a far smaller number than a
word id. The children of one node are a range of a level; each range goes on from the last
number of the one before, so a whole level is one increasing list, and where ranges begin is a
monotone list of pointers. A child is found by a successor search for its number in its context.
"""

from __future__ import annotations

import struct

import numpy as np

#: Probabilities are kept as -log10 in steps of 1/4096, to 10**-16: an error of 0.00013 at most.
STEP = 4096.0

#: Entries with equal high bits that a search reads one by one before it halves the rest.
_STEPS = 4
_L8, _H8 = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_5, _3, _F = np.uint64(0x5555555555555555), np.uint64(0x3333333333333333), np.uint64(0x0F0F0F0F0F0F0F0F)
#: Place of the k-th one of a byte, by 8 * byte + k.
_IN_BYTE = np.array([([j for j in range(8) if b >> j & 1] + [0] * 8)[k] for b in range(256) for k in range(8)], dtype=np.int64)


def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one (from 0) of each word: sums of ones up to each byte, then a table."""
    s = word - ((word >> np.uint64(1)) & _5)
    s = (s & _3) + ((s >> np.uint64(2)) & _3)
    s = ((s + (s >> np.uint64(4))) & _F) * _L8
    rank = k.astype(np.uint64)
    place = np.bitwise_count(((rank * _L8 | _H8) - s) & _H8).astype(np.uint64) * np.uint64(8)
    rank -= ((s << np.uint64(8)) >> place) & np.uint64(0xFF)
    byte = (word >> place) & np.uint64(0xFF)
    return place.astype(np.int64) + _IN_BYTE[(byte * np.uint64(8) + rank).astype(np.int64)]


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 * STEP), 0, 65535).astype("<u2")


def restored(codes: np.ndarray) -> np.ndarray:
    return codes / -STEP


def _packed(bits: np.ndarray) -> np.ndarray:
    raw = np.packbits(bits, bitorder="little")
    return np.concatenate([raw, np.zeros(16 - len(raw) % 8, dtype=np.uint8)]).view("<u8")


class EliasFano:
    """An increasing list of integers (equal neighbours allowed)."""

    def __init__(self, n: int, low_bits: int, lows: np.ndarray, highs: np.ndarray, ones: np.ndarray) -> None:
        self.n, self.low_bits, self.lows, self.highs, self.ones = n, low_bits, lows, highs, ones
        self._runs: np.ndarray | None = None

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, dtype=np.int64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = np.zeros(n + (top >> low_bits) + 1, dtype=bool)
        bits[(values >> low_bits) + np.arange(n)] = True
        highs = _packed(bits)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(highs), dtype=np.int64)])[:-1]
        planes = np.empty((n, low_bits), dtype=bool)
        for k in range(low_bits):
            planes[:, k] = values >> k & 1
        return cls(n, low_bits, _packed(planes.ravel()), highs, ones)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], dtype="<i8"), self.lows, self.highs, self.ones.astype("<u4")]

    @classmethod
    def from_parts(cls, parts: list[np.ndarray]) -> "EliasFano":
        (n, low_bits), lows, highs, ones = parts
        return cls(int(n), int(low_bits), lows, highs, ones.astype(np.int64))

    def _select(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) one among the high bits."""
        at = np.searchsorted(self.ones, k, side="right") - 1
        return at * 64 + _select_in_word(self.highs[at], k - self.ones[at])

    def runs(self) -> np.ndarray:
        """For each number of high bits, up to one beyond the last, the first entry that has as many or more: four bytes
        each, about as many as entries. One pass over the high bits finds them for all searches in this list."""
        if self._runs is None:
            bits = np.unpackbits(np.ascontiguousarray(self.highs).view(np.uint8), bitorder="little")
            zeros = np.flatnonzero(bits == 0)
            # As many zeros as its high bits are before the last entry, and one behind it.
            zeros = zeros[: np.searchsorted(zeros, self._select(np.array([self.n - 1]))[0]) + 1] if self.n else zeros[:1]
            self._runs = np.concatenate([[0], zeros - np.arange(len(zeros))]).astype(np.int32 if self.n < 1 << 31 else np.int64)
        return self._runs

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), dtype=np.int64)
        bit = at * self.low_bits
        word, off = bit >> 6, (bit & 63).astype(np.uint64)
        # A shift by 64 is no shift, so the next word is moved in two steps.
        both = (self.lows[word] >> off) | ((self.lows[word + 1] << np.uint64(1)) << (np.uint64(63) - off))
        return (both & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, dtype=np.int64)
        return ((self._select(at) - at) << self.low_bits) | self._low(at)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Position of the first entry equal to each value, -1 where there is none."""
        values = np.asarray(values, dtype=np.int64)
        if not self.n or not len(values):
            return np.full(len(values), -1)
        runs = self.runs()
        high = values >> self.low_bits
        out = np.full(len(values), -1)
        asked = np.flatnonzero((values >= 0) & (high < len(runs) - 1))
        high = high[asked]
        a, end = runs[high].astype(np.int64), runs[high + 1].astype(np.int64)
        low = values[asked] & ((1 << self.low_bits) - 1)
        # Entries with these high bits are those from a to end; among them the low bits increase.
        for _ in range(_STEPS):  # such runs are short
            on = a < end
            if not on.all():
                asked, low, a, end = asked[on], low[on], a[on], end[on]
            here = self._low(a)
            hit = here == low
            out[asked[hit]] = a[hit]
            on = here < low
            asked, low, a, end = asked[on], low[on], a[on] + 1, end[on]
            if not len(asked):
                return out
        b = end
        for _ in range(int((b - a).max()).bit_length()):
            middle = (a + b) >> 1
            less = (a < b) & (self._low(np.minimum(middle, self.n - 1)) < low)
            a, b = np.where(less, middle + 1, a), np.where(less | (a >= b), b, middle)
        hit = (a < end) & (self._low(np.minimum(a, self.n - 1)) == low)
        out[asked[hit]] = a[hit]
        return out


class Level:
    """Children of the nodes of the level before: a range each."""

    def __init__(self, starts: EliasFano, values: EliasFano) -> None:
        self.starts, self.values = starts, values

    @classmethod
    def of(cls, parents: np.ndarray, ids: np.ndarray, n_parents: int) -> "Level":
        """``parents`` and, within a parent, ``ids`` increase; both sorted together, no pair twice."""
        starts = np.searchsorted(parents, np.arange(n_parents + 1))
        last = np.flatnonzero(np.append(parents[1:] != parents[:-1], True)) if len(ids) else np.zeros(0, dtype=np.int64)
        ends = np.cumsum(ids[last] + 1)
        base = np.repeat(np.concatenate([[0], ends])[: len(last)], np.diff(np.concatenate([[-1], last])))
        return cls(EliasFano.of(starts), EliasFano.of(base + ids + 1))

    def parts(self) -> list[np.ndarray]:
        return self.starts.parts() + self.values.parts()

    def find(self, parents: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Position of child ``ids`` of node ``parents``, -1 where either is -1 or there is none."""
        out = np.full(len(ids), -1)
        asked = np.flatnonzero((parents >= 0) & (ids >= 0))
        node = parents[asked]
        first = firsts(node)  # queries come in runs of one parent
        times = np.diff(np.append(first, len(node)))
        node = node[first]
        start, end = self.starts[node], self.starts[node + 1]
        base = np.where(start > 0, self.values[np.maximum(start - 1, 0)], 0) if self.values.n else start
        at = self.values.find(np.repeat(base, times) + ids[asked] + 1)
        out[asked] = np.where((at >= np.repeat(start, times)) & (at < np.repeat(end, times)), at, -1)
        return out

    def relative(self, parents: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Positions of a level as positions among the children of their parents (-1 stays)."""
        first = firsts(parents)
        node = parents[first]
        start = np.where(node >= 0, self.starts[np.maximum(node, 0)], 0)
        return np.where(at >= 0, at - np.repeat(start, np.diff(np.append(first, len(parents)))), -1)


class Trie:
    """Levels and quantised probabilities; ``codes`` are those of ``after``, of ``third``, and the weights of backing off."""

    PARTS = 4 + 8 + 8 + 8

    def __init__(self, words: EliasFano, after: Level, before: Level, third: Level, codes: list[np.ndarray]) -> None:
        self.words, self.after, self.before, self.third = words, after, before, third
        self.p_after, self.p_third, self.back_word, self.back_pair = codes

    def to_bytes(self) -> bytes:
        parts = self.words.parts() + self.after.parts() + self.before.parts() + self.third.parts() + [self.p_after, self.p_third, self.back_word, self.back_pair]
        out = [struct.pack("<q", len(parts))]
        for p in parts:
            raw = p.tobytes()
            kind = {"<u8": 0, "<u4": 1, "<u2": 2, "<i8": 3}[p.dtype.str]
            out += [struct.pack("<qq", kind, len(raw)), raw, bytes(-len(raw) % 8)]
        return b"".join(out)

    @classmethod
    def open(cls, buffer) -> "Trie":
        """The trie over a buffer's bytes, nothing copied but the running counts; a search adds where runs begin."""
        (n,), at, parts = struct.unpack_from("<q", buffer, 0), 8, []
        for _ in range(n):
            kind, size = struct.unpack_from("<qq", buffer, at)
            dtype = np.dtype(("<u8", "<u4", "<u2", "<i8")[kind])
            parts.append(np.frombuffer(buffer, dtype, size // dtype.itemsize, at + 16))
            at += 16 + size + -size % 8
        fano = [EliasFano.from_parts(parts[k : k + 4]) for k in range(0, cls.PARTS, 4)]
        return cls(fano[0], Level(*fano[1:3]), Level(*fano[3:5]), Level(*fano[5:7]), parts[cls.PARTS :])

    @classmethod
    def build(
        cls, ids: np.ndarray, i1: np.ndarray, i2: np.ndarray, i3: np.ndarray, n: np.ndarray, log_unigram: np.ndarray, discount: float,
        given: tuple[np.ndarray, ...] | None = None,
    ) -> "Trie":
        """From distinct triples, as places in the sorted word ``ids``, with counts; ``log_unigram`` belongs to ``ids``.
        They come sorted by middle word, word before and word after.

        Interpolated absolute discounting: each count gives up ``discount``, and what a history
        gives up is spread over all words as the shorter history has them.

        ``given`` are counts over the whole corpus of histories that are spread over several tries: per word
        its total and how many words follow it (0: all its triples are here); per triple the count of its
        last two words, its own count, and the total and following words of its first two (0: all here).
        """
        words = EliasFano.of(ids)
        # What follows each word.
        by = np.argsort(i2.astype(np.int64) * len(ids) + i3, kind="stable").astype(np.int32)
        first = firsts(i2[by], i3[by])
        parent, child, n2 = i2[by][first], i3[by][first], totals(n[by], first)
        number = _numbers(first, len(by))
        if given is not None:
            word_total, word_kinds, two, three, of_pair, after_pair = given
            n2 = np.where(word_kinds[parent] > 0, two[by][first], n2)
            seen = n2 > 0
            number = np.where(seen, np.cumsum(seen) - 1, -1)[number].astype(np.int32)
            parent, child, n2 = parent[seen], child[seen], n2[seen]
        at = np.empty(len(by), dtype=np.int32)
        at[by] = number  # the pair of each triple
        del by, number
        total, kinds = np.bincount(parent, n2, len(ids)), np.bincount(parent, minlength=len(ids))
        if given is not None:
            total, kinds = np.where(word_kinds > 0, word_total, total), np.where(word_kinds > 0, word_kinds, kinds)
        spare = np.divide(discount * kinds, total, out=np.ones(len(ids)), where=total > 0)
        p2 = (n2 - discount) / total[parent] + spare[parent] * 10.0 ** log_unigram[child]
        after = Level.of(parent, child, len(ids))
        # What precedes each word, and what follows both.
        if given is not None:
            n = np.where(of_pair > 0, three, n)
            own = np.flatnonzero((n > 0) | (of_pair > 0))
            i1, i2, n, at, of_pair, after_pair = i1[own], i2[own], n[own], at[own], of_pair[own], after_pair[own]
        pair_first = firsts(i2, i1)
        pair = _numbers(pair_first, len(i2))
        before = Level.of(i2[pair_first], i1[pair_first], len(ids))
        pair_total, pair_kinds = np.bincount(pair, n, len(pair_first)), np.bincount(pair, n > 0, len(pair_first))
        if given is not None:
            of_pair, after_pair = of_pair[pair_first], after_pair[pair_first]
            pair_total, pair_kinds = np.where(of_pair > 0, of_pair, pair_total), np.where(of_pair > 0, after_pair, pair_kinds)
            own = np.flatnonzero(n > 0)
            pair, i2, n, at = pair[own], i2[own], n[own], at[own]
        pair_spare = discount * pair_kinds / pair_total
        p3 = (n - discount) / pair_total[pair] + pair_spare[pair] * p2[at]
        begin = np.searchsorted(parent, np.arange(len(ids)))
        third = Level.of(pair, at - begin[i2], len(pair_first))
        return cls(words, after, before, third, [quantised(np.log10(p)) for p in (p2, p3, spare, pair_spare)])

    def log10(self, ids: np.ndarray, x1: np.ndarray, x2: np.ndarray, x3: np.ndarray, log_unigram: np.ndarray) -> np.ndarray:
        """log10 p(w3 | w1 w2) of triples given as places in ``ids``; ``log_unigram`` belongs to ``ids``."""
        place = self.words.find(ids)
        i1, i2, i3 = place[x1], place[x2], place[x3]
        two = self.after.find(i2, i3)
        first = firsts(x2, x1)  # pairs come in runs, too
        pair = np.repeat(self.before.find(i2[first], i1[first]), np.diff(np.append(first, len(x1))))
        three = self.third.find(pair, self.after.relative(i2, two))
        back2 = np.where(i2 >= 0, restored(_taken(self.back_word, i2)), 0.0)
        p2 = np.where(two >= 0, restored(_taken(self.p_after, two)), back2 + log_unigram[x3])
        back3 = np.where(pair >= 0, restored(_taken(self.back_pair, pair)), 0.0)
        return np.where(three >= 0, restored(_taken(self.p_third, three)), back3 + p2)


def _taken(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    return codes[np.maximum(at, 0)] if len(codes) else np.zeros(len(at), dtype="<u2")


def firsts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    if not len(keys[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(len(keys[0]), dtype=bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _numbers(first: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` entries, the number of its run."""
    return np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, n)))


def totals(n: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(n, first) if len(first) else n[:0]
