"""Benchmark decontamination with spaced seeds.

A word is a run of letters, digits and bytes above 127, ASCII letters lower-cased. Each of four fixed masks
hashes six words and ignores those between them, so substituted words do not hide a passage. Together the masks hit
every stretch of ``LEAST`` or more words of which 80 percent agree: a test goes through all substitutions in 13 to
25 words, and a longer stretch has a part of such a length that agrees as much. Hashes of documents and of benchmark items are
joined; around each hit the two word sequences are laid side by side, and the longest stretch that agrees
in at least 80 percent of its words counts.
A document is contaminated by an item if that stretch has ``LEAST`` words, or all words of a shorter item.

Documents send only what a bitmap of the benchmark's hashes (fixed size, built by tasks) lets through: hits
and the words around them. A full bitmap would let everything through and change no result.

Defined cases: null texts have no words; items shorter than ``LEAST`` have masks of their own length, which leave out
as many blocks of words as words may differ; items need at least ``SHORTEST`` words; repeated rows and repeated items are found each; other columns do no harm;
empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats, seqhash
from .repeats import staged

#: Fixed masks: 1 is a word that must agree.
MASKS = ("1101111", "11100001011", "11010100011", "1101010011")
LEAST, SHORTEST, PERCENT = 13, 5, 80
BITMAP_BITS = 24

_U = np.uint64
_FACTORS = seqhash.mix(np.arange(1, LEAST + 1, dtype=_U)) | _U(1)


def _is_word_byte() -> np.ndarray:
    table = np.zeros(256, bool)
    table[128:] = True
    table[[*range(48, 58), *range(97, 123)]] = True
    return table


_WORD_BYTE = _is_word_byte()


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = seqhash.lower_ascii(data)
    spaced = np.where(_WORD_BYTE[data], data, np.uint8(32))
    starts, ends, before = seqhash.word_bounds(spaced, at)
    return seqhash.word_hashes(spaced, starts, ends), before


def short_masks(length: int) -> list[str]:
    """Masks over a whole short item: some leaves out all blocks in which the words that may differ lie."""
    errors = length * (100 - PERCENT) // 100
    blocks = (5 if length == SHORTEST else 3) if errors == 1 else (5 if length == 10 else 4)
    block = [i * blocks // length for i in range(length)]
    return ["".join("01"[b not in out] for b in block) for out in combinations(range(blocks), errors)]


def _hashes(values: np.ndarray, mask: str, number: int) -> np.ndarray:
    """Of the words that ``mask`` asks for, at each place where it fits into ``values``."""
    n = len(values) - len(mask) + 1
    h = np.full(max(0, n), number, _U)
    for i in np.flatnonzero([bit == "1" for bit in mask]) if n > 0 else ():
        h += values[i : i + n] * _FACTORS[i]
    return seqhash.mix(h)


def seeds(values: np.ndarray, before: np.ndarray, short: list[int], whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, hash) of every mask at every place, and of the masks of short lengths; ``whole``: of these
    only in texts that have that length."""
    masks = [(mask, number + 1, 0) for number, mask in enumerate(MASKS)]
    masks += [(mask, n << 8 | number, n) for n in short for number, mask in enumerate(short_masks(n))]
    of = np.repeat(np.arange(len(before) - 1), np.diff(before))
    found = []
    for mask, number, length in masks:
        h = _hashes(values, mask, number)
        text = of[: len(h)]
        inside = np.arange(len(h)) + len(mask) <= before[text + 1]
        if whole and length:
            inside &= np.diff(before)[text] == length
        place = np.flatnonzero(inside)
        found.append((text[place], place - before[text[place]], h[place]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _short_lengths(items: DataFrame) -> list[int]:
    """Lengths below ``LEAST`` that items have: a few numbers."""
    return sorted(r["n"] for r in items.where((F.col("n") >= SHORTEST) & (F.col("n") < LEAST)).select("n").distinct().collect())


def _items(benchmark: DataFrame) -> DataFrame:
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, at in seqhash.slices(batch["text"]):
                values, before = words(data, at)
                rows = [values[a:b].tobytes() for a, b in zip(before[:-1], before[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch["item_id"].slice(row, len(rows)), pa.array(np.diff(before)), pa.array(rows, pa.binary())], names=["item_id", "n", "item"])

    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(describe, "item_id long, n long, item binary")


def _item_seeds(items: DataFrame, short: list[int]) -> DataFrame:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch["item"].to_pylist()), _U)
            before = np.append(0, np.cumsum(batch["n"].to_numpy()))
            text, place, h = seeds(values, before, short, True)
            yield pa.RecordBatch.from_arrays([batch["item_id"].take(pa.array(text)), pa.array(place.astype("i4")), pa.array(seqhash.signed(h))], names=["item_id", "item_at", "seed"])

    return items.where(F.col("n") > 0).mapInArrow(hashed, "item_id long, item_at int, seed long")


def _bitmap(item_seeds: DataFrame) -> np.ndarray:
    """Bits of all seeds, eight to a byte; the driver gets at most 2**BITMAP_BITS / 64 numbers."""
    slot = F.shiftrightunsigned("seed", 64 - BITMAP_BITS)
    words_ = item_seeds.select(F.shiftright(slot, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - BITMAP_BITS}) & 63 as int))").alias("bit"))
    table = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for r in words_.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        table[r["word"]] = r["bits"]
    return table.astype("<i8").view(np.uint8)


def _in_bitmap(bits: np.ndarray, seed: np.ndarray) -> np.ndarray:
    slot = seed >> _U(64 - BITMAP_BITS)
    return (bits[(slot >> _U(3)).astype(np.int64)] >> (slot & _U(7)).astype(np.uint8)) & 1 == 1


_STRETCH = "doc_id long, doc long, mark long, base int, words binary, seed array<long>, place array<int>"


def _stretches(docs: DataFrame, bitmap: np.ndarray, reach: int, short: list[int]) -> DataFrame:
    """Words around the seeds that the bitmap lets through, one row per stretch without a gap."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            doc_id, doc, mark = batch["doc_id"], batch["doc"].to_numpy(), batch["mark"].to_numpy()
            for row, data, at in seqhash.slices(batch["text"]):
                values, before = words(data, at)
                text, place, h = seeds(values, before, short, False)
                hit = _in_bitmap(bits, h)
                text, place, h = text[hit], place[hit], h[hit]
                order = np.lexsort((place, text))
                text, place, h = text[order], place[order], h[order]
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (place[1:] - place[:-1] > 2 * reach)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(text))[: len(first)]
                rows: list[list] = [[] for _ in range(7)]
                for a, b in zip(first, last, strict=True):
                    t = text[a]
                    low = max(0, place[a] - reach)
                    high = min(before[t + 1] - before[t], place[b - 1] + LEAST + reach)
                    stretch = values[before[t] + low : before[t] + high].tobytes()
                    for column, value in zip(rows, (doc_id[int(row + t)].as_py(), doc[row + t], mark[row + t], low, stretch, seqhash.signed(h[a:b]), place[a:b].astype("i4")), strict=True):
                        column.append(value)
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=["doc_id", "doc", "mark", "base", "words", "seed", "place"])

    return repeats.identified_with_id(docs).mapInArrow(look, _STRETCH)


def longest_agreement(agree: np.ndarray, percent: int = PERCENT) -> tuple[int, int]:
    """(length, agreeing words) of the longest stretch with at least ``percent`` of its words agreeing."""
    gain = np.append(0, np.cumsum(np.where(agree, 100 - percent, -percent)))
    lowest = np.minimum.accumulate(gain)
    highest = np.maximum.accumulate(gain[::-1])[::-1]
    best, start, end = (0, 0), 0, 0
    while end < len(gain) and start < len(gain):
        if highest[end] >= lowest[start]:
            if end - start > best[1] - best[0]:
                best = (start, end)
            end += 1
        else:
            start += 1
    return best[1] - best[0], int(agree[best[0] : best[1]].sum())


_FOUND = "doc_id long, doc long, mark long, item_id long, item_words int, overlap_words int, agreeing_words int"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that it contains: doc_id, doc, mark, item_id, item_words, overlap_words, agreeing_words.

    ``doc`` and ``mark`` tell apart rows that share or lack a doc_id (``repeats.identified``).
    """
    items = staged(_items(benchmark), "items")
    short = _short_lengths(items)
    reach = items.agg(F.max("n")).first()[0] or 0
    item_seeds = staged(_item_seeds(items, short), "item-seeds")
    stretches = staged(_stretches(docs, _bitmap(item_seeds), int(reach), short), "stretches")
    hits = stretches.select("doc", "mark", "base", F.explode(F.arrays_zip("seed", "place")).alias("s"))
    hits = hits.select("doc", "mark", "base", F.col("s.seed").alias("seed"), F.col("s.place").alias("place"))
    lines = (
        hits.join(item_seeds, "seed")
        .select("doc", "mark", "base", "item_id", (F.col("place") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    side = lines.join(stretches.select("doc_id", "doc", "mark", "base", "words"), ["doc", "mark", "base"]).join(items, "item_id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch[c] for c in ("doc_id", "doc", "mark", "base", "item_id", "shift", "words", "item"))
            for doc_id, doc, mark, base, item_id, shift, own, other in zip(*columns, strict=True):
                one, two = (np.frombuffer(v.as_buffer(), _U) for v in (own, other))
                low = shift.as_py() - base.as_py()  # where the item begins in the stretch
                a, b = max(0, low), min(len(one), low + len(two))
                length, agreeing = longest_agreement(one[a:b] == two[a - low : b - low])
                if length >= min(LEAST, len(two)):
                    rows.append((doc_id.as_py(), doc.as_py(), mark.as_py(), item_id.as_py(), len(two), length, agreeing))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in _FOUND.split(", ")])

    best = F.max(F.struct("overlap_words", "agreeing_words", "item_words")).alias("best")
    return (
        side.mapInArrow(verify, _FOUND)
        .groupBy("doc_id", "doc", "mark", "item_id").agg(best)
        .select("doc_id", "doc", "mark", "item_id", "best.item_words", "best.overlap_words", "best.agreeing_words")
    )


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """As ``contaminated``, without ``doc`` and ``mark``: texts that share or lack a doc_id have a row each, equal rows one."""
    return contaminated(docs, benchmark).drop("doc", "mark")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    found = staged(contaminated(docs, benchmark).select(F.col("doc").alias("_contaminated_doc"), F.col("mark").alias("_contaminated_mark")).distinct(), "contaminated")
    own = dict(zip(("_contaminated_doc", "_contaminated_mark"), repeats._identity()[:2], strict=True))
    return docs.withColumns(own).join(found, ["_contaminated_doc", "_contaminated_mark"], "left_anti").drop("_contaminated_doc", "_contaminated_mark")
