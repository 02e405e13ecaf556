"""Spelling variants: words one edit apart, found by an index of variable-length grams.

1. Dictionary. Grams of ``SHORTEST`` to ``LONGEST`` characters of the framed word (``^word$``) are counted over all distinct words; only
   those standing more often than a 65,536th of all grams are kept, so there are fewer than 65,536 of them, whatever the input.
2. Decomposition. From each position the gram grows until it is no longer in that pruned dictionary, ends the word or is ``LONGEST`` long. It
   depends on its own characters only, so an edit changes just the grams that cover it. A gram bears the number of its occurrence in the word.
3. Bound. No edit affects more grams of a word than cover one of its characters (``affected``, at most ``LONGEST``). Two near words so
   share at least ``grams - affected`` of either, which is one or more for words of ``LONGEST`` characters or more.
4. Lists. Of the grams that an edit leaves alone, the rarest is among the first ``affected + 1`` of either word, rare ones first. So each word is
   listed under these grams, and lists are merged: words of one list whose lengths differ by one at most must share as many grams as
   the greater of their bounds. A list of more than ``CROWD`` words is first split by what stands before the gram, and by what stands
   after it: one edit leaves one of the two alone. Words of a part that is still longer, words whose bound is below one and very long words are found by their
   single deletions, whose groups are bounded by the alphabet: of two words one edit apart one is a deletion of the other, or they have one in common.
5. Verification: exact edit distance.

A word's form is the near word that stands most often (ties: the smallest), if it does ``factor`` times as often. Forms are followed to
their root by doubling: counts grow by ``factor`` with every step, so few rounds are needed.

Defined cases: null and empty texts have no words; a null doc_id counts as empty in the hash that decides on slips; repeated rows count
as often as they stand; very long runs are words like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import seqhash
from .repeats import staged

SHORTEST, LONGEST = 2, 5
#: Words of a list that are compared pair by pair.
CROWD = 1024
#: Characters of a word from which on it is found by its deletions.
VERY_LONG = 4096
MIN_LENGTH, MIN_COUNT, FACTOR = 6, 5, 5
#: One run in so many loses a character.
SLIP = 199
#: Upper bound of the dictionary's entries.
_DICTIONARY = 1 << 16
#: Distinct words a task holds before it hands them on.
_HELD = 1 << 18

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_WORD = "word string, n long"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def counted(docs: DataFrame, slip: int | None = SLIP, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the runs of letters in all texts, ``A-Z`` lower-cased. Where ``slip`` divides the crc32 of ``<doc_id>:<run>``, one character is lost."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                runs = Counter(_RUN.findall(text.as_py().encode().lower().decode())) if text.is_valid else {}
                begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in runs.items():
                    if slip is not None:
                        h = zlib.crc32(run.encode(), begin)
                        if h % slip == 0:
                            run = run[: h % len(run)] + run[h % len(run) + 1 :]
                    if len(run) >= min_length:
                        held[run] += n
                if len(held) > _HELD:
                    yield _rows(held)
                    held.clear()
        yield _rows(held)

    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(count, _WORD)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _rows(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])


# ---------------------------------------------------------------- grams
def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()
    for batch in batches:
        for word in batch["word"]:
            framed = f"^{word.as_py()}$"
            for q in range(SHORTEST, LONGEST + 1):
                held.update(framed[p : p + q] for p in range(len(framed) - q + 1))
            if len(held) > _HELD:
                yield _rows(held)
                held.clear()
    yield _rows(held)


def dictionary(words: DataFrame) -> dict[str, int]:
    """Frequent grams and their counts; fewer than ``_DICTIONARY`` entries by its threshold."""
    grams = staged(words.select("word").mapInArrow(_count_grams, _WORD).groupBy("word").agg(F.sum("n").alias("n")), "grams")
    total = grams.agg(F.sum("n")).first()[0] or 0
    return {r["word"]: r["n"] for r in grams.where(F.col("n") > total // _DICTIONARY).where("n > 1").collect()}


def decompose(word: str, frequent: dict[str, int]) -> tuple[list[str], int]:
    """The gram at each position of the framed word, and how many at most cover one character."""
    framed = f"^{word}$"
    grams = []
    edge = np.zeros(len(framed) + 1, int)
    for p in range(len(framed) - SHORTEST + 1):
        end = p + SHORTEST
        while end < len(framed) and end - p < LONGEST and framed[p:end] in frequent:
            end += 1
        grams.append(framed[p:end])
        edge[p] += 1
        edge[end] -= 1
    return grams, int(np.cumsum(edge).max())


def tokens(word: str, frequent: dict[str, int]) -> tuple[list[tuple[str, int]], int]:
    """The word's grams, each with the number of its occurrence, rare ones first, and the bound of affected ones."""
    grams, affected = decompose(word, frequent)
    met: Counter[str] = Counter()
    found = []
    for gram in grams:
        met[gram] += 1
        found.append((frequent.get(gram, 0), gram, met[gram]))
    return [(g, k) for _, g, k in sorted(found)], affected


_INDEXED = "word string, n long, size int, tokens array<long>, bound int, grams array<string>"


def _index(frequent: dict[str, int]) -> Callable:
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed, bounds, listed, sizes = [], [], [], []
            for word in batch["word"].to_pylist():
                found, affected = tokens(word, frequent)
                hashed.append([xxhash.xxh64_intdigest(f"{g}{k}") - (1 << 63) for g, k in found])
                listed.append(list(dict.fromkeys(g for g, _ in found[: affected + 1])))
                bounds.append(len(found) - affected)
                sizes.append(len(word))
            columns = [pa.array(sizes, pa.int32()), pa.array(hashed, pa.list_(pa.int64())), pa.array(bounds, pa.int32()), pa.array(listed, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch["word"], batch["n"], *columns], names=["word", "n", "size", "tokens", "bound", "grams"])

    return index


# ---------------------------------------------------------------- near words
def near_pairs(words: DataFrame, crowd: int = CROWD, very_long: int = VERY_LONG) -> DataFrame:
    """(one, two, n_one, n_two): each pair of words (word, n) one edit apart, once."""
    # ids hold since the table is written
    index = staged(words.select("word", "n").mapInArrow(_index(dictionary(words)), _INDEXED).withColumn("id", F.monotonically_increasing_id()), "index")
    entries = index.withColumn("key", F.explode("grams")).drop("grams")
    lists = staged(entries.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "lists")
    entries = entries.where(F.col("size") <= very_long)
    light = entries.join(lists.where(F.col("members") <= crowd).select("key"), "key")
    enough = F.size(F.array_intersect("tokens_one", "tokens_two")) >= F.greatest("bound_one", "bound_two")
    merged = _met(light, ["word", "n", "tokens", "bound"]).where(enough)

    crowded = entries.join(lists.where(F.col("members") > crowd).select("key"), "key")
    parts = staged(crowded.select("id", "word", "n", "size", "key").mapInArrow(_contexts, "id long, word string, n long, size int, key long"), "contexts")
    sizes = staged(parts.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "parts")
    split = _met(parts.join(sizes.where(F.col("members") <= crowd).select("key"), "key"), ["word", "n"])

    rest = parts.join(sizes.where(F.col("members") > crowd), "key").select("id", "word")
    rest = staged(rest.unionByName(index.where((F.col("bound") < 1) | (F.col("size") >= very_long)).select("id", "word")).distinct(), "rest")
    pair = ["word_one", "word_two", "n_one", "n_two"]
    near = F.levenshtein("word_one", "word_two", 1) == 1
    met = merged.select(pair).unionByName(split.select(pair)).where(near)
    turned = F.col("word_one") > F.col("word_two")
    lesser = [F.when(turned, F.col(f"{c}_two")).otherwise(F.col(f"{c}_one")).alias(f"{c}_one") for c in ("word", "n")]
    greater = [F.when(turned, F.col(f"{c}_one")).otherwise(F.col(f"{c}_two")).alias(f"{c}_two") for c in ("word", "n")]
    met = met.select(*lesser, *greater).unionByName(_verified(_by_deletions(index, rest).select(pair)))
    return met.distinct().withColumnsRenamed({"word_one": "one", "word_two": "two"})


def _met(listed: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs of one list whose lengths are equal, once, or differ by one."""
    side = lambda name: [F.col(c).alias(f"{c}_{name}") for c in columns]
    one = listed.select("key", F.col("size").alias("length"), *side("one"), F.lit(True).alias("_"))
    two = listed.select("key", F.explode(F.array(F.col("size"), F.col("size") + 1)).alias("length"), F.col("size").alias("own"), *side("two"))
    return one.join(two, ["key", "length"]).where("own < length or word_one < word_two")


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A list's word under what stands before and after each occurrence of the list's gram, that included."""
    for batch in batches:
        of, keys = [], []
        for i, (word, gram) in enumerate(zip(batch["word"].to_pylist(), batch["key"].to_pylist(), strict=True)):
            framed = f"^{word}$"
            at, met = framed.find(gram), set()
            while at >= 0:
                met.add(xxhash.xxh64_intdigest(f"{gram}<{framed[:at]}") - (1 << 63))
                met.add(xxhash.xxh64_intdigest(f"{gram}>{framed[at + len(gram) :]}") - (1 << 63))
                at = framed.find(gram, at + 1)
            of += [i] * len(met)
            keys += met
        rows = batch.take(pa.array(of, pa.int64()))
        yield pa.RecordBatch.from_arrays([*(rows[c] for c in ("id", "word", "n", "size")), pa.array(keys, pa.int64())], names=["id", "word", "n", "size", "key"])


def _verified(met: DataFrame) -> DataFrame:
    """Pairs exactly one edit apart, words of any length among them."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [one_edit(a.as_py(), b.as_py()) for a, b in zip(batch["word_one"], batch["word_two"], strict=True)]
            yield batch.filter(pa.array(near, pa.bool_()))

    return met.mapInArrow(verify, "word_one string, word_two string, n_one long, n_two long")


def one_edit(one: str, two: str) -> bool:
    """Whether exactly one character is inserted, deleted or replaced; time grows with the length, also of very long words."""
    one, two = sorted((one, two), key=len)
    if one == two or len(two) - len(one) > 1:
        return False
    low, high = 0, len(one)  # the first ``low`` characters agree, the first ``high + 1`` don't
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if one[low:middle] == two[low:middle] else (low, middle - 1)
    return one[low:] == two[low + 1 :] if len(one) < len(two) else one[low + 1 :] == two[low + 1 :]


def _by_deletions(index: DataFrame, rest: DataFrame) -> DataFrame:
    """Pairs among ``rest`` (id, word) by equal hashes of single deletions; hashes travel, not words, whatever their length."""
    keys = rest.mapInArrow(_deletions, "key long, id long").distinct()
    keys = staged(keys, "deletions")
    pairs = keys.withColumnRenamed("id", "id_one").join(keys.withColumnRenamed("id", "id_two"), "key")
    pairs = pairs.where("id_one <> id_two").select("id_one", "id_two").distinct()
    for side in ("one", "two"):
        pairs = pairs.join(index.select(F.col("id").alias(f"id_{side}"), F.col("word").alias(f"word_{side}"), F.col("n").alias(f"n_{side}")), f"id_{side}")
    return pairs.where("word_one < word_two")


def _deletions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of the word and of each of its single deletions: a sum of characters times powers of a base."""
    for batch in batches:
        words = batch["word"].to_pylist()
        sizes = np.array([len(w) for w in words], np.int64)
        codes = seqhash.mix(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1))
        up = np.cumprod(np.full(sizes.max(initial=0), _BASE, np.uint64), dtype=np.uint64)
        first = np.cumsum(sizes) - sizes
        place = np.arange(len(codes)) - np.repeat(first, sizes)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up[place], dtype=np.uint64)])
        whole, before = sums[first + sizes] - sums[first], sums[:-1] - np.repeat(sums[first], sizes)
        after = np.repeat(sums[first + sizes], sizes) - sums[1:]
        hashes = np.concatenate([whole, before + after * _INVERSE])
        ids = batch["id"].to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(seqhash.signed(hashes)), pa.array(np.concatenate([ids, np.repeat(ids, sizes)]))], names=["key", "id"])


# ---------------------------------------------------------------- forms and roots
def variants(words: DataFrame, factor: int = FACTOR, crowd: int = CROWD, very_long: int = VERY_LONG) -> DataFrame:
    """Per word of ``words`` (word, n; distinct): form, root, n, n_near, form_n."""
    words = staged(words.select("word", "n"), "words")
    pairs = staged(near_pairs(words, crowd, very_long), "pairs")
    ways = pairs.select(F.col("one").alias("word"), F.col("two").alias("near"), F.col("n_two").alias("near_n")).unionByName(
        pairs.select(F.col("two").alias("word"), F.col("one").alias("near"), F.col("n_one").alias("near_n"))
    )
    best = ways.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = words.join(best, "word", "left")
    often = -F.col("best.less") >= factor * F.col("n")
    found = staged(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("best.near")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = staged(found.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    rooted = found.join(roots, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
