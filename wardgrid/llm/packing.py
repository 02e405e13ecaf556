"""Best-fit packing with Martello-Toth dominance reduction, planned on the histogram of lengths.

Pieces of one length are alike, so the plan needs only how many pieces each length has: at most ``capacity``
numbers, whatever the size of the corpus. The plan is a list of patterns (which lengths share a sequence, and how
many sequences look so), also bounded by the capacity. The pieces then take the places of their length by number.

Reduction, longest piece first: if a small set with it provably dominates every other set that could
share its sequence, that set is fixed for good. What is left is packed best-fit decreasing.

Defined cases: null or empty texts are one closing id; repeated rows are packed each; a missing doc_id stays
missing; other columns do no harm; empty tables give no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .repeats import staged

CAPACITY, END_ID = 4096, 1

Pattern = tuple[int, dict[int, int]]  # sequences, {length: pieces of it in each}


class _Left:
    """How many pieces of each length are left; lengths in ascending order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: n for k, n in counts.items() if n}
        self.lengths = sorted(self.counts)

    def take(self, lengths: dict[int, int], times: int) -> None:
        for k, each in lengths.items():
            self.counts[k] -= each * times
            if not self.counts[k]:
                del self.counts[k]
                del self.lengths[bisect_left(self.lengths, k)]

    def largest(self, most: int, without: dict[int, int] | None = None) -> int:
        """Largest length up to ``most`` with a piece besides ``without``; 0 if none."""
        i = bisect_left(self.lengths, most + 1) - 1
        while i >= 0 and without and self.counts[self.lengths[i]] <= without.get(self.lengths[i], 0):
            i -= 1
        return self.lengths[i] if i >= 0 else 0

    def smallest(self, n: int, without: dict[int, int], above: int = 0) -> list[int]:
        found: list[int] = []
        for k in self.lengths[bisect_left(self.lengths, above + 1) :]:
            found += [k] * min(n - len(found), self.counts[k] - without.get(k, 0))
            if len(found) == n:
                break
        return found

    def best_pair(self, room: int, without: dict[int, int]) -> tuple[int, int]:
        """Two lengths with the largest sum up to ``room``; zeros if no two fit."""
        best, low, high = (0, 0), 0, bisect_left(self.lengths, room) - 1
        free = lambda k: self.counts[k] - without.get(k, 0)
        while low <= high:
            a, b = self.lengths[low], self.lengths[high]
            if not free(a):
                low += 1
            elif not free(b) or a + b > room or (a == b and free(a) < 2):
                high -= 1
            else:
                if a + b > sum(best):
                    best = (a, b)
                low += 1
        return best


def _bag(*lengths: int) -> dict[int, int]:
    bag: dict[int, int] = defaultdict(int)
    for k in lengths:
        bag[k] += 1
    return dict(bag)


def _dominating(left: _Left, longest: int, capacity: int) -> dict[int, int] | None:
    """The set with a piece of length ``longest`` that dominates all others, if a small one provably does."""
    room, used = capacity - longest, {longest: 1}
    partner = left.largest(room, used)
    if not partner:
        return used
    least = left.smallest(3, used)
    if partner == room or len(least) < 2 or least[0] + least[1] > room:
        return _bag(longest, partner)
    if len(least) < 3 or sum(least) > room:
        a, b = left.best_pair(room, used)
        if partner >= a + b:
            return _bag(longest, partner)
        larger = left.smallest(2, used, above=a)  # of another pair, one piece would have to be no longer than a
        if b == partner and (len(larger) < 2 or sum(larger) > room):
            return _bag(longest, a, b)
    return None


def reduced(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Patterns fixed by dominance, and the counts that remain."""
    left, fixed = _Left(counts), []
    changed = True
    while changed:
        changed = False
        for longest in reversed(left.lengths.copy()):
            while left.counts.get(longest):
                bag = _dominating(left, longest, capacity)
                if bag is None:
                    break
                times = min(left.counts[k] // each for k, each in bag.items())
                left.take(bag, times)
                fixed.append((times, bag))
                changed = True
    return fixed, left.counts


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing, all pieces of one length at a time."""
    groups: dict[int, list[Pattern]] = defaultdict(list)  # by free room
    rooms: list[int] = []

    def put(pattern: Pattern, room: int) -> None:
        if room not in groups or not groups[room]:
            insort(rooms, room)
        groups[room].append(pattern)

    for length in sorted(counts, reverse=True):
        waiting = counts[length]
        while waiting:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                times, bag = groups[room].pop()
                if not groups[room]:
                    del rooms[i]
            else:
                room, times, bag = capacity, -(-waiting // (capacity // length)), {}
            each = room // length
            full = min(times, waiting // each)
            if full:
                put((full, {**bag, length: each}), room - each * length)
                waiting -= full * each
            rest = times - full
            if rest and 0 < waiting < each:
                put((1, {**bag, length: waiting}), room - waiting * length)
                waiting, rest = 0, rest - 1
            if rest and bag:
                put((rest, bag), room)
    return [p for room in rooms for p in groups[room]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    fixed, rest = reduced(counts, capacity)
    return fixed + best_fit(rest, capacity)


def _places(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """For each length rows (first number, first sequence, pieces in each sequence, offset there)."""
    rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    given: dict[int, int] = defaultdict(int)
    base = 0
    for times, bag in patterns:
        offset = 0
        for length, each in bag.items():
            rows[length].append((given[length], base, each, offset))
            given[length] += each * times
            offset += each * length
        base += times
    return {k: np.array(v, np.int64) for k, v in rows.items()}


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """Each document's ids, cut after every ``capacity`` of them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, ids, at in tokens.encoded(batch["text"], path, end_id):
                number = -(-np.diff(at) // capacity)
                of = np.repeat(np.arange(len(number)), number)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
                low = at[of] + piece * capacity
                high = np.minimum(low + capacity, at[of + 1])
                little = ids.astype("<u4")
                raw = [little[a:b].tobytes() for a, b in zip(low, high, strict=True)]
                columns = [batch["doc_id"].take(pa.array(of + row)), piece.astype("i4"), low - at[of], high - low, np.array([zlib.crc32(r) for r in raw], np.int64)]
                columns = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns] + ([pa.array(raw, pa.binary())] if with_ids else [])
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, _PIECE + (", ids binary" if with_ids else ""))


def _numbered(ranged: DataFrame, schema: str) -> DataFrame:
    """Rows in order of length, with their task and their number among those of their length in it."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = -1, 0
        for batch in batches:
            length = batch["length"].to_numpy()
            if not len(length):
                continue
            new = np.append(True, length[1:] != length[:-1])
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            ordinal = np.arange(len(length)) - first + np.where((first == 0) & (length == last), count, 0)
            last, count = length[-1], int(ordinal[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ordinal)], names=[*batch.schema.names, "ordinal"])

    return ranged.withColumn("task", F.spark_partition_id()).mapInArrow(number, f"{schema}, task int, ordinal long")


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and its ``ids`` if asked for."""
    schema = _PIECE + (", ids binary" if with_ids else "")
    cut = staged(pieces(docs, path or tokens.default_path(), capacity, end_id, with_ids), "pieces")
    keys = ["length", "doc_id", "start"]
    numbered = staged(_numbered(cut.repartitionByRange(*keys).sortWithinPartitions(*keys), schema), "numbered")
    by_task = numbered.groupBy("length", "task").count().collect()  # at most one row per length and one more per task
    counts: dict[int, int] = defaultdict(int)
    before: dict[tuple[int, int], int] = {}
    for r in sorted(by_task, key=lambda r: (r["length"], r["task"])):
        before[r["length"], r["task"]] = counts[r["length"]]
        counts[r["length"]] += r["count"]
    places = _places(plan(dict(counts), capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, task, number = (batch[c].to_numpy() for c in ("length", "task", "ordinal"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            number = number + np.array([before[k] for k in zip(length.tolist(), task.tolist(), strict=True)], np.int64)
            for k in np.unique(length):
                rows = np.flatnonzero(length == k)
                table = places[int(k)]
                at = table[np.searchsorted(table[:, 0], number[rows], "right") - 1]
                inside = number[rows] - at[:, 0]
                sequence[rows] = at[:, 1] + inside // at[:, 2]
                offset[rows] = at[:, 3] + inside % at[:, 2] * k
            kept = [batch[c] for c in batch.schema.names if c not in ("task", "ordinal")]
            names = [c for c in batch.schema.names if c not in ("task", "ordinal")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return numbered.mapInArrow(place, f"{schema}, sequence_id long, offset long")
