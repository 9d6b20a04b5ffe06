"""Best-fit packing of token sequences by bin completion.

Documents become ids once; only pieces longer than a sequence are cut. Pieces that fill a
sequence are done. The others are dealt evenly, by a hash of their running number, to groups of
about ``GROUP`` pieces that pack independently, so that a group's size doesn't grow with the
input and neither a source nor a repeated document makes it larger. In a group, best-fit
decreasing gives the first incumbent; then branch-and-bound completes one sequence after the
other around the largest piece left, over undominated fillings in order of their waste, and
prunes where the waste so far shows that no better packing follows, or where the same pieces were
left over before and couldn't be packed. ``NODES``, ``STEPS``, ``FILLINGS`` and ``ENUMERATED`` bound that
search, not the result: each piece is placed in the incumbent that it ends with. What a group can't
fill lies in its emptiest sequences; those of many groups are packed once more together.

Rows: a null text is an empty text, which has its end id and so is a piece of one id. Repeated
rows are pieces of their own; null ids are kept. An empty table gives no rows. Only the two
named columns are read. Ties go to the smaller id.
"""

from __future__ import annotations

import sys
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare, staged
from ledgerlake.llm.tokens import encoder, gathered

GROUP = 4096
#: Emptiest sequences of a group that are taken apart and packed once more, with those of other groups.
LOOSE = 16
#: Sequences that the search of a group closes at most, and steps within one filling.
NODES, STEPS, FILLINGS = 20_000, 400, 4
#: Undominated fillings of a bin that are enumerated at most, of which the ``FILLINGS`` with least waste are tried.
ENUMERATED = 8 * FILLINGS


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing over lengths in descending order: the positions in each bin."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (room left, bin), ascending
    for i, n in enumerate(lengths):
        k = bisect_left(room, (n, -1))
        if k < len(room):
            left, b = room.pop(k)
            bins[b].append(i)
            left -= n
        else:
            b, left = len(bins), capacity - n
            bins.append([i])
        if left:
            insort(room, (left, b))
    return bins


def fewest(lengths: list[int], capacity: int) -> int:
    """No packing has fewer bins.

    For any least size k: pieces over capacity - k stand alone as far as pieces of at least k go,
    pieces over half a bin never share one, and what other pieces of at least k don't find room
    for beside those needs bins of its own.
    """
    n = np.sort(np.asarray(lengths, dtype=np.int64))
    total = np.concatenate([[0], np.cumsum(n)])
    half = int(np.searchsorted(n, capacity // 2, side="right"))
    best = -(-int(total[-1]) // capacity)
    for k in np.unique(np.append(n[:half], 0)).tolist():
        alone = int(np.searchsorted(n, capacity - k, side="right"))
        first = int(np.searchsorted(n, k, side="left"))
        alone = max(alone, half)
        room = (alone - half) * capacity - int(total[alone] - total[half])
        rest = int(total[half] - total[min(first, half)]) - room
        best = max(best, len(n) - half + max(0, -(-rest // capacity)))
    return best


class _Search:
    def __init__(self, lengths: list[int], capacity: int, nodes: int) -> None:
        self.sizes = sorted(set(lengths), reverse=True)
        self.ascending = [-n for n in self.sizes]
        self.left = [0] * len(self.sizes)
        place = {n: k for k, n in enumerate(self.sizes)}
        for n in lengths:
            self.left[place[n]] += 1
        #: Places of sizes of which some are left, largest first.
        self.live = list(range(len(self.sizes)))
        rng = np.random.default_rng(0)
        self.marks = [int(x) for x in rng.integers(1, 1 << 62, len(self.sizes))]
        self.state = 0
        self.capacity, self.nodes, self.total = capacity, nodes, sum(lengths)
        self.floor = fewest(lengths, capacity)

    def take(self, k: int) -> None:
        self.left[k] -= 1
        self.state += self.marks[k]
        if not self.left[k]:
            del self.live[bisect_left(self.live, k)]

    def give(self, k: int) -> None:
        if not self.left[k]:
            insort(self.live, k)
        self.left[k] += 1
        self.state -= self.marks[k]

    def fillings(self, room: int, spare: int) -> list[tuple[int, list[int]]]:
        """(waste, sizes by position) of undominated fillings of ``room``, least waste first.

        Only those that waste no more than ``spare`` are worth a test, or that leave no piece.
        """
        sizes, ascending, left, live = self.sizes, self.ascending, self.left, self.live
        # the two smallest pieces together
        two = 0
        if live:
            two = sizes[live[-1]] + (sizes[live[-1]] if left[live[-1]] > 1 else sizes[live[-2]] if len(live) > 1 else self.capacity)
        found, steps, end = [], 0, len(live)
        chosen: list[int] = []
        skipped: list[int] = []  # ascending; some of each are left over

        def dominated(room: int) -> bool:
            """Whether a skipped piece fits beside the chosen ones, or in place of a smaller one."""
            if not skipped:
                return False
            if sizes[skipped[-1]] <= room:
                return True
            before = -1
            for c in chosen:
                if c != before:
                    before = c
                    i = bisect_left(skipped, bisect_left(ascending, -sizes[c] - room))
                    if i < len(skipped) and skipped[i] < c:
                        return True
            return False

        def go(at: int, room: int) -> bool:
            nonlocal steps
            steps += 1
            at = bisect_left(live, bisect_left(ascending, -room), at) if at < end else end
            if at == end:
                if (room <= spare or not skipped) and not dominated(room):
                    found.append((room, chosen[:]))
                return room == 0 or steps > STEPS or len(found) >= ENUMERATED
            # equal pieces are one step: as many as fit first, then fewer
            k = live[at]
            size = sizes[k]
            most = min(left[k], room // size)
            chosen.extend([k] * most)
            done = go(at + 1, room - most * size)
            skipped.append(k)
            for n in range(most - 1, -1, -1):
                if done or steps > STEPS:
                    break
                del chosen[-1]
                # with no or one piece more, the skipped one would fit beside it or in its place
                if room - n * size >= two:
                    done = go(at + 1, room - n * size)
            skipped.pop()
            while chosen and chosen[-1] == k:
                del chosen[-1]
            return done or steps > STEPS

        go(0, room)
        found.sort(key=lambda x: x[0])
        return found[:FILLINGS]

    def run(self, incumbent: int) -> list[list[int]] | None:
        """Bins (as positions in ``sizes``) of a packing with fewer bins than ``incumbent``, if one is found."""
        best, bins, waste = None, [], 0
        goal, pending = incumbent, sum(self.left)
        stack: list[list[tuple[int, list[int]]]] = []
        #: Remainders searched in vain, with the fewest bins closed before them: the same pieces closed in another
        #: order leave the same remainder, which as many or more closed bins can't finish either.
        refuted: dict[int, int] = {}

        def descend() -> None:
            k = self.live[0]
            self.take(k)
            room, spare = self.capacity - self.sizes[k], (goal - 1) * self.capacity - self.total - waste
            options = self.fillings(room, spare) or ([(room, [])] if room <= spare or pending == 1 else [])
            self.give(k)
            stack.append([(w, [k, *c]) for w, c in reversed(options)])

        descend()
        while stack and self.nodes > 0 and goal > self.floor:
            if len(bins) == len(stack):  # back from below: take this bin apart
                refuted[self.state] = min(refuted.get(self.state, goal), len(bins))
                w, b = bins.pop()
                waste -= w
                pending += len(b)
                for k in b:
                    self.give(k)
            if not stack[-1]:
                stack.pop()
                continue
            w, b = stack[-1].pop()
            # a packing with goal - 1 bins wastes no more than this
            last = len(b) == pending
            if (waste + (0 if last else w) > (goal - 1) * self.capacity - self.total) or len(bins) + 1 >= goal:
                continue
            for k in b:
                self.take(k)
            if refuted.get(self.state, goal) <= len(bins) + 1:
                for k in b:
                    self.give(k)
                continue
            self.nodes -= 1
            pending -= len(b)
            waste += w
            bins.append((w, b))
            if pending:
                descend()
            else:
                best, goal = [x for _, x in bins], len(bins)
        return best


def complete(lengths: list[int], capacity: int, nodes: int = NODES) -> list[list[int]]:
    """Positions of ``lengths`` (each from 1 to ``capacity``) by bin, in as few bins as the search finds."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    ranked = [lengths[i] for i in order]
    bins = best_fit(ranked, capacity)
    if len(bins) > fewest(ranked, capacity):
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * capacity + 1000))
        search = _Search(ranked, capacity, nodes)
        if (better := search.run(len(bins))) is not None:
            own: dict[int, list[int]] = {}
            for i in range(len(ranked) - 1, -1, -1):
                own.setdefault(ranked[i], []).append(i)
            bins = [[own[search.sizes[k]].pop() for k in b] for b in better]
    return [[order[i] for i in b] for b in bins]


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = encoder(path), TaskContext.get().partitionId(), 0
        for b in gathered(batches, "text"):
            ids, counts = enc.encode(b.column("text"))
            ends = np.cumsum(counts + 1)
            full = np.empty(int(ends[-1]), dtype="<u4")
            last = np.zeros(len(full), dtype=bool)
            last[ends - 1] = True
            full[last], full[~last] = end_id, ids
            data = memoryview(full.tobytes())
            n_pieces = -(-(counts + 1) // capacity)
            doc = np.repeat(np.arange(len(counts)), n_pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = piece * capacity
            length = np.minimum(capacity, (counts + 1)[doc] - start)
            first = (ends - counts - 1)[doc] + start
            own = [data[4 * a : 4 * (a + n)] for a, n in zip(first.tolist(), length.tolist(), strict=True)]
            columns = [
                pa.array(np.full(len(doc), part, dtype=np.int64)), pa.array(np.arange(at, at + len(doc))), b.column("doc_id").take(pa.array(doc)),
                pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array([zlib.crc32(x) for x in own], pa.int64()),
            ]
            at += len(doc)
            names = ["part", "seq", "doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array([bytes(x) for x in own], pa.binary())] if with_ids else []), names=names + ["ids"] * with_ids)

    return run


#: Tasks that groups are dealt to at most, as a multiple of the shuffle partitions.
TASKS = 20
_ORDER = [("length", "descending"), *((c, "ascending") for c in ("doc_id", "piece", "part", "seq"))]


def _placed(pieces: pa.Table, bins: list[list[int]], first: int) -> pa.Table:
    """``pieces`` with the sequence, the offset, and whether the sequence is among the emptiest."""
    lengths = pieces["length"].to_pylist()
    sequence = np.zeros(len(lengths), dtype=np.int64)
    offset = np.zeros(len(lengths), dtype=np.int64)
    used = np.zeros(len(bins), dtype=np.int64)
    for k, b in enumerate(bins):
        for i in b:
            sequence[i], offset[i] = k, used[k]
            used[k] += lengths[i]
    loose = np.zeros(len(bins), dtype=bool)
    loose[np.argsort(used, kind="stable")[:LOOSE]] = True
    for name, values in (("sequence_id", first + sequence), ("offset", offset), ("loose", loose[sequence])):
        pieces = pieces.append_column(name, pa.array(values))
    return pieces


def _packed(capacity: int):
    def run(pieces: pa.Table) -> pa.Table:
        pieces = pieces.sort_by(_ORDER)
        first = pieces["pack"][0].as_py() << 32
        return _placed(pieces.drop_columns(["pack"]), complete(pieces["length"].to_pylist(), capacity), first)

    return run


def _repacked(capacity: int, groups: int):
    """The emptiest sequences of many groups: packed anew if that needs fewer, else as they are."""

    def run(pieces: pa.Table) -> pa.Table:
        pieces = pieces.sort_by(_ORDER)
        bins = complete(pieces["length"].to_pylist(), capacity)
        if len(bins) >= len(pieces["sequence_id"].unique()):
            return pieces.drop_columns(["pack"])
        first = (groups + pieces["pack"][0].as_py()) << 32
        return _placed(pieces.drop_columns(["pack", "sequence_id", "offset", "loose"]), bins, first)

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "part long, seq long, doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = staged(rows.mapInArrow(_pieces(tokenizer, capacity, end_id, with_ids), schema + ", ids binary" * with_ids), "pieces")
    light = pieces.drop("ids")
    groups = max(1, -(-light.where(F.col("length") < capacity).count() // GROUP))

    def dealt(rows: DataFrame, groups: int, *by: str) -> DataFrame:
        # A group is seconds of work, so groups are spread over tasks rather than joined by their few bytes.
        tasks = min(groups, TASKS * int(spark.conf.get("spark.sql.shuffle.partitions")))
        return rows.withColumn("pack", F.pmod(F.xxhash64(*by), F.lit(groups))).repartition(tasks, "pack").groupBy("pack")

    # Running numbers differ from row to row, so the hash deals any rows out evenly.
    own = schema + ", sequence_id long, offset long, loose boolean"
    packed = dealt(light.where(F.col("length") < capacity), groups, "part", "seq").applyInArrow(_packed(capacity), own)
    if groups > 1:
        packed = staged(packed, "packed")
        loose = packed.where("loose")
        again = max(1, -(-loose.count() // GROUP))
        packed = packed.where("NOT loose").unionByName(dealt(loose, again, "sequence_id").applyInArrow(_repacked(capacity, groups), own))
    packed = packed.drop("loose")
    full = light.where(F.col("length") == capacity).withColumns(
        {"sequence_id": -1 - (F.shiftleft("part", 40) + F.col("seq")), "offset": F.lit(0).cast("long")}
    )
    out = packed.unionByName(full)
    if with_ids:
        out = out.join(pieces.select("part", "seq", "ids"), ["part", "seq"])
    return out.drop("part", "seq")
