"""Suffix-array deduplication: bytes covered by a long string that also starts elsewhere.

1. Every window of ``length`` bytes chooses a part of ``PART`` bytes by least hash, so equal windows
   choose equal parts. Neighbouring windows with one choice form a run; a document has about one
   run per 70 bytes, and only runs are shuffled.
2. Runs whose part no other run has cannot hold a repeat. A body (all bytes of a run's windows) that
   stands twice repeats in whole. Of the rest, each distinct body is brought once, with its count.
3. Bodies with one part meet in one place. Per piece of about ``PIECE`` bytes a suffix array is
   sorted in two stages (``suffix_sort``) and neighbours that agree in ``length`` bytes form classes;
   a class that stands twice or more, counts included, is repeated.
4. A part with more than ``CROWD`` distinct bodies is not brought into one task: its windows are
   counted by 128 bits of hash, with one row per window and task. No case is dropped.

Defined cases: null text is empty; texts shorter than ``length`` keep all; repeated rows are copies of
each other; a missing doc_id is a document of its own; other columns do no harm; empty tables give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats, seqhash
from .suffix_sort import adjacent_prefixes, suffix_order

LENGTH = 200
PART = 32
PIECE = 1 << 19
CROWD = 4096

_BODY = "part long,body long,n long,doc long,mark long,low int,count int,crowded boolean,text binary"
_SPAN = "doc long, mark long, low int, end int"


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc, mark, spans (low, end): stretches covered by a string of ``length`` bytes that also starts elsewhere."""
    texts = repeats.searched(docs)
    found = repeats.staged(repeats.runs(texts, repeats.bytes_of, length, min(PART, length)), "runs")
    alive = repeats.staged(repeats.with_repeated_part(found), "alive")
    distinct = repeats.staged(repeats.bodies(alive), "bodies")
    several = distinct.where("several")
    crowds = several.groupBy("part").count().where(F.col("count") > CROWD).select("part", F.lit(True).alias("crowded"))
    wanted = several.join(crowds, "part", "left").select(
        "place.doc", "place.mark", "place.low", "place.high", "part", "body", "n", F.coalesce("crowded", F.lit(False)).alias("crowded")
    )

    def cut(doc, mark, _, data, places):
        low = places.field("low").to_pylist()
        count = [h - x + 1 for h, x in zip(places.field("high").to_pylist(), low, strict=True)]
        names = ("part", "body", "n")
        n = len(low)
        texts = [data[x : x + c + length - 1] for x, c in zip(low, count, strict=True)]
        return [*(places.field(k).to_pylist() for k in names), [doc] * n, [mark] * n, low, count, places.field("crowded").to_pylist(), texts]

    brought = repeats.staged(repeats.pieces(texts, wanted, cut, _BODY), "texts")
    met = (
        brought.where("not crowded").repartition("part").sortWithinPartitions("part").mapInArrow(_by_suffixes(length), _SPAN)
    )
    return (
        repeats.whole_runs(alive, distinct, length)
        .unionByName(repeats.single(met))
        .unionByName(repeats.single(_by_counting(brought.where("crowded"), length)))
    )


def _by_suffixes(length: int):
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            part = batch["part"].to_numpy()
            ends = np.append(np.flatnonzero(np.diff(part)) + 1, batch.num_rows)
            begin = 0
            weight = np.cumsum(np.asarray(pa.compute.binary_length(batch["text"])))
            while begin < batch.num_rows:
                if held and size >= PIECE and part[begin] != held[-1]["part"][-1].as_py():
                    yield _repeated_in(held, length)
                    held, size = [], 0
                past = weight[begin - 1] if begin else 0
                full = int(np.searchsorted(weight, past + max(1, PIECE - size)))
                end = int(ends[min(np.searchsorted(ends, full, "right"), len(ends) - 1)])
                held.append(batch.slice(begin, end - begin))
                size += int(weight[end - 1] - past)
                begin = end
        if held:
            yield _repeated_in(held, length)

    return sort


def _repeated_in(held: list[pa.RecordBatch], length: int) -> pa.RecordBatch:
    """Spans of the bodies that stand once, as far as their windows stand in another body too."""
    table = pa.Table.from_batches(held).combine_chunks()
    bodies, at = seqhash.utf8(table["text"])
    rows = len(at) - 1
    n, count = table["n"].to_numpy(), table["count"].to_numpy()
    data = np.full(len(bodies) + rows, 255, np.uint8)  # no byte of UTF-8 text
    begins = at[:-1] + np.arange(rows)
    data[np.arange(len(bodies)) + np.repeat(np.arange(rows), np.diff(at))] = bodies
    order, words = suffix_order(data, length)
    row_of = np.repeat(np.arange(rows), np.diff(at) + 1)
    starts_window = np.arange(len(data)) - begins[row_of] < count[row_of]
    order = order[starts_window[order]]
    classes = np.cumsum(~adjacent_prefixes(words, order, length)) - 1
    stands = np.bincount(classes, weights=n[row_of[order]], minlength=1)[classes] >= 2
    found = np.sort(order[stands & (n[row_of[order]] == 1)])
    return _spans(row_of[found], found - begins[row_of[found]], table, length)


def _spans(rows: np.ndarray, offsets: np.ndarray, table: pa.Table, length: int) -> pa.RecordBatch:
    """Neighbouring window starts as one span."""
    new = np.ones(len(rows), bool)
    new[1:] = (np.diff(rows) != 0) | (np.diff(offsets) != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1 if len(rows) else first
    row = rows[first]
    low = table["low"].to_numpy()[row]
    columns = [table["doc"].to_numpy()[row], table["mark"].to_numpy()[row], (low + offsets[first]).astype("i4"), (low + offsets[last] + length).astype("i4")]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "mark", "low", "end"])


def _by_counting(crowded: DataFrame, length: int) -> DataFrame:
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["one", "two", "n", "doc", "mark", "low"]
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch["text"][i].as_buffer(), np.uint8)
                one = seqhash.Rolling(seqhash.byte_values(data)).every(length)
                two = seqhash.Rolling(seqhash.mix(seqhash.byte_values(data) + np.uint64(1))).every(length)
                fixed = [pa.array(np.full(len(one), batch[c][i].as_py(), t)) for c, t in (("n", "i8"), ("doc", "i8"), ("mark", "i8"))]
                low = batch["low"][i].as_py() + np.arange(len(one), dtype="i4")
                yield pa.RecordBatch.from_arrays([pa.array(seqhash.signed(one)), pa.array(seqhash.signed(two)), *fixed, pa.array(low)], names=names)

    each = crowded.mapInArrow(windows, "one long, two long, n long, doc long, mark long, low int")
    twice = each.groupBy("one", "two").agg(F.sum("n").alias("stands")).where("stands > 1").select("one", "two")
    return each.where("n = 1").join(twice, ["one", "two"], "left_semi").select("doc", "mark", "low", (F.col("low") + length).cast("int").alias("end"))


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def suffix_dedup(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """Per document what stays: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and ``kept`` bytes if asked for."""
    spans = repeats.by_document(repeats.staged(repeated_spans(docs, length), "spans"))
    joined = repeats.identified_with_id(docs).join(spans, ["doc", "mark"], "left").select("doc_id", "text", "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = seqhash.utf8(batch["text"])
            rows = []
            for i, spans in enumerate(batch["spans"]):
                text = data[at[i] : at[i + 1]]
                gone = repeats.covered(len(text), spans.values if spans.is_valid else None)
                kept = text[~gone].tobytes()
                runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
                rows.append((len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            arrays = [batch["doc_id"], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays(arrays[: 5 + with_text], names=names[: 5 + with_text])

    return joined.mapInArrow(remove, _RESULT + (", kept binary" if with_text else ""))
