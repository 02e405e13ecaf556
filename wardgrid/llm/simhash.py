"""SimHash fingerprints of documents, and all pairs within a Hamming radius by permuted block tables.

Terms are words and pairs of neighbouring words, ASCII letters lower-cased. A term's weight is the
square root of its count, times how rare its kind is by length: one for words of up to three bytes, two for
longer ones, three for pairs. Each of ``BITS`` bits of its hash votes with that weight; a fingerprint bit is the sign of the sum.

Search: a fingerprint is cut into ``radius + extra`` blocks; each table puts another choice of ``extra``
blocks first and groups by them. Fingerprints within the radius agree in some choice, so every pair is
met. Equal fingerprints are one row. The rows of groups that are too large are dealt again by
a choice of one more block out of more, which again every pair shares somewhere.

Defined cases: null text is empty; a text without words has the fingerprint of zeros; the edited text of an
empty text is empty; the last document is followed by the first, a single one by itself; rows without
doc_id come last, rows that share one (or none) stand in the order of a hash of their texts, however many they are in several tasks; other columns do no harm; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import seqhash
from .repeats import staged

BITS = 128
#: Bytes of text that a block holds at most, on average.
BLOCK = 64 << 20
_U = np.uint64
_BYTES = BITS // 8
_TABLE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64) * 2 - 1


def _terms(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, weight) of the distinct terms of each text."""
    data = seqhash.lower_ascii(data)
    starts, ends, before = seqhash.word_bounds(data, at)
    words = seqhash.word_hashes(data, starts, ends)
    of = np.repeat(np.arange(len(before) - 1), np.diff(before))
    pairs = np.flatnonzero(of[1:] == of[:-1])
    hashes = np.concatenate([words, seqhash.mix(words[pairs] * _U(3) + words[pairs + 1])])
    kind = np.concatenate([np.where(ends - starts > 3, 2.0, 1.0), np.full(len(pairs), 3.0)])
    text = np.concatenate([of, of[pairs]])
    order = np.lexsort((hashes, text))
    text, hashes, kind = text[order], hashes[order], kind[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(text)))
    return text[first], hashes[first], np.sqrt(count) * kind[first]


def fingerprints(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of ``BITS / 8`` bytes per text. Votes are tallied per byte value, then spread over its bits."""
    texts = len(at) - 1
    text, hashes, weight = _terms(data, at)
    out = np.zeros((texts, _BYTES), np.uint8)
    halves = [seqhash.mix(hashes + _U(i)) for i in range(BITS // 64)]
    for low in range(0, texts, 1000):
        a, b = np.searchsorted(text, (low, min(low + 1000, texts)))
        rows = min(1000, texts - low)
        for i in range(_BYTES):
            byte = (halves[i // 8][a:b] >> _U(8 * (i % 8))) & _U(255)
            tally = np.bincount((text[a:b] - low) * 256 + byte.astype(np.int64), weights=weight[a:b], minlength=rows * 256)
            out[low : low + rows, i] = np.packbits(tally.reshape(rows, 256) @ _TABLE > 1e-9, axis=1)[:, 0]
    return out


def likeness(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Cosine that the share of differing bits stands for, at least 0."""
    differ = np.unpackbits(one ^ two, axis=1).sum(axis=1)
    return np.where(differ == 0, 1.0, np.maximum(np.cos(np.pi * differ / BITS), 0.0))


def _prints(texts: list[str]) -> np.ndarray:
    column = pa.array(texts, pa.large_string())
    parts = [fingerprints(data, at) for _, data, at in seqhash.slices(column)]
    return np.concatenate(parts) if parts else np.zeros((0, _BYTES), np.uint8)


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _blocks(docs: DataFrame) -> int:
    """Twice the shuffle partitions, more where that would give blocks of over ``BLOCK`` bytes."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK))


def _numbered(docs: DataFrame, blocks: int) -> DataFrame:
    """Rows with ``block``, a number that ascends in the order of rows: doc_id descending, none last, then the hash of the text.

    A doc_id (or none) that several of ``blocks`` equal shares would cut is dealt by hash into as many blocks.
    """
    rows, known = docs.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    cuts = docs.where("doc_id is not null").approxQuantile("doc_id", [i / blocks for i in range(1, blocks)], 0.5 / blocks) if blocks > 1 and known else []
    bounds = sorted({int(c) for c in cuts})
    hot = {c: n for c in bounds if (n := sum(int(x) == c for x in cuts)) > 1}
    shares = max([-(-blocks * (rows - known) // max(rows, 1)), *hot.values(), 1])
    above = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda cut: F.col("doc_id") >= cut)) if bounds else F.lit(0)
    # the hash is uniform: equal stretches of its upper half are equal shares of the rows
    stretch = F.shiftright((F.shiftright("hash", 32) + F.lit(1 << 31)) * F.lit(shares), 32)
    split = F.col("doc_id").isNull() | (F.col("doc_id").isin(*hot) if hot else F.lit(False))
    main = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(F.lit(len(bounds)) - above).cast("long")
    return docs.withColumn("block", main * F.lit(shares + 1) + F.when(split, stretch + 1).otherwise(F.lit(0)))


def _dealt(docs: DataFrame, blocks: int | None) -> DataFrame:
    """Every document in a block of neighbouring rows, with the first row of the next block at its end.

    Only the first row's doc_id and hash of each block come to the driver; texts are shuffled once. ``times`` counts rows that
    are equal: of more than two, one stands for all but the last, as each of them is followed by its like.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = _two_of_equal(docs.withColumn("hash", F.xxhash64("text")))
    numbered = _numbered(docs, blocks or _blocks(docs))
    first = F.max(F.struct("doc_id", F.bitwise_not("hash").alias("turned"))).alias("first")
    heads = sorted(numbered.groupBy("block").agg(first).select("block", "first.*").collect(), key=lambda r: r["block"])  # one row per block
    columns = ["block", "borrowed", "times", "doc_id", "hash", "text"]
    if not heads:
        return numbered.withColumn("borrowed", F.lit(False)).select(*columns)
    # the head of each block also closes the block before it; the first head closes the last block
    closes = [(r["doc_id"], ~r["turned"], r["block"], heads[i - 1]["block"]) for i, r in enumerate(heads)]
    end = docs.sparkSession.createDataFrame(closes, "head long, head_hash long, from_block long, closed long")
    same = F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("hash") == F.col("head_hash")) & (F.col("block") == F.col("from_block"))
    borrowed = numbered.join(F.broadcast(end), same).groupBy(F.col("closed").alias("block")).agg(F.min("text").alias("text"))
    borrowed = borrowed.withColumns({"borrowed": F.lit(True), "times": F.lit(1).cast("long"), "doc_id": F.lit(None).cast("long"), "hash": F.lit(0).cast("long")})
    rows = numbered.withColumn("borrowed", F.lit(False)).select(*columns).unionByName(borrowed.select(*columns))
    return rows.repartition(len(heads), "block").sortWithinPartitions(
        "block", "borrowed", F.col("doc_id").desc_nulls_last(), "hash", "text", F.col("times").desc()
    )


def _two_of_equal(docs: DataFrame) -> DataFrame:
    """``docs`` with ``times``; of more than two rows equal in doc_id and text, one with all but one of them and one more."""
    mark = F.xxhash64(F.lit(1), "text")
    many = staged(docs.groupBy("doc_id", "hash", mark.alias("mark")).agg(F.count(F.lit(1)).alias("n")).where("n > 2"), "simhash-equal")
    if many.isEmpty():
        return docs.withColumn("times", F.lit(1).cast("long"))
    docs, many = docs.withColumn("mark", mark).alias("d"), many.alias("m")
    equal = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.hash") == F.col("m.hash")) & (F.col("d.mark") == F.col("m.mark"))
    few = docs.join(many, equal, "left_anti").select("doc_id", "text", "hash", F.lit(1).cast("long").alias("times"))
    one = docs.join(many, equal).select("d.*", "m.n").groupBy("doc_id", "hash", "mark").agg(F.first("text").alias("text"), F.max("n").alias("n"))
    two = one.select("doc_id", "text", "hash", F.explode(F.array(F.col("n") - 1, F.lit(1).cast("long"))).alias("times"))
    return few.unionByName(staged(two, "simhash-two-of-equal"))


def edited_fingerprints(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Per document its fingerprint, that of its text with a second half from the next document, and likenesses.

    The next document is the next lower doc_id; after the last comes the first.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # the rows from the last batch that still miss their next one
        for batch in batches:
            rows = waiting + list(zip(*(batch[c].to_pylist() for c in ("times", "borrowed", "doc_id", "text")), strict=True))
            for low in range(0, len(rows) - 1, 500):
                yield _compared(rows[low : low + 501])
            waiting = rows[-1:]

    found = _dealt(docs, blocks).select("times", "borrowed", "doc_id", "text").mapInArrow(compare, f"{_RESULT}, times long")
    return found.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("_", "times")


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    """Of all rows but the last, each with the row after it; borrowed rows only close their block."""
    own = [i for i in range(len(rows) - 1) if not rows[i][1]]
    texts = [r[3] for r in rows]
    edited = []
    for i in own:
        half = len(texts[i]) // 2
        edited.append(texts[i][: len(texts[i]) - half] + texts[i + 1][:half])
    plain, changed = _prints(texts), _prints(edited)
    at = np.array(own, np.int64)
    columns = [
        pa.array([rows[i][2] for i in own], pa.int64()),
        pa.array([len(texts[i]) for i in own], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        pa.array([plain[i].tobytes().hex() for i in own], pa.string()),
        pa.array([c.tobytes().hex() for c in changed], pa.string()),
        pa.array(likeness(plain[at], changed), pa.float64()),
        pa.array(likeness(plain[at], plain[at + 1]), pa.float64()),
        pa.array([rows[i][0] for i in own], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in f"{_RESULT}, times".split(", ")])


def within_radius(prints: DataFrame, radius: int = 3, extra: int = 2, crowd: int = 64) -> DataFrame:
    """(a, b, distance), a < b: all pairs of distinct fingerprints (hex, column ``fingerprint``) within ``radius`` bits.

    Rows of one fingerprint are its members: join on it. Groups of more than ``crowd`` rows use choices of
    one more block, until all blocks outside the radius are chosen.
    """
    distinct = prints.select("fingerprint").where(f"length(fingerprint) = {BITS // 4}").distinct()
    found = None
    rows, chosen = distinct, extra
    while True:
        blocks = radius + chosen
        cuts = [round(i * (BITS // 4) / blocks) for i in range(blocks + 1)]
        block = [F.substring("fingerprint", a + 1, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        tables = [F.struct(F.lit(i).alias("t"), F.concat(*(block[j] for j in c)).alias("key")) for i, c in enumerate(combinations(range(blocks), chosen))]
        dealt = rows.select("fingerprint", F.explode(F.array(*tables)).alias("g")).select("fingerprint", "g.t", "g.key")
        sizes = staged(dealt.groupBy("t", "key").count().where("count > 1"), "block-sizes")
        last = (radius + chosen + 1) > BITS // 4 or chosen >= extra + 3
        small = dealt.join(sizes if last else sizes.where(F.col("count") <= crowd), ["t", "key"]).select("fingerprint", "t", "key")
        one, two = small.withColumnRenamed("fingerprint", "a"), small.withColumnRenamed("fingerprint", "b")
        differ = sum(
            F.bit_count(F.conv(F.substring("a", i, 8), 16, 10).cast("long").bitwiseXOR(F.conv(F.substring("b", i, 8), 16, 10).cast("long")))
            for i in range(1, BITS // 4, 8)
        )
        pairs = one.join(two, ["t", "key"]).where("a < b").select("a", "b").distinct().withColumn("distance", differ).where(F.col("distance") <= radius)
        found = pairs if found is None else found.unionByName(pairs).distinct()
        crowded = sizes.where(F.col("count") > crowd)
        if last or not crowded.limit(1).count():
            return found
        rows = staged(dealt.join(crowded, ["t", "key"]).select("fingerprint").distinct(), "crowded")
        chosen += 1
