"""Substring deduplication by level-wise doubling: words covered by a window that also starts elsewhere.

Lengths 9, 18, 35 (in general: a quarter of the window, then twice as long each time, the last level
being the window). Only what is repeated at one length is extended to the next; all else ends there.

* Level 1: of the 9-word parts of each 35-word window, the one with the least hash is counted over all
  documents (``seqhash.chosen``: equal windows choose equal parts, and a document has one choice per
  twelve words). Windows whose choice stands once cannot repeat.
* Level 2 does the same with 18-word parts on the surviving stretches, which are written as text.
* Last level: stretches of windows that stand twice as a whole are repeated. Of the rest each distinct
  stretch is brought once, with its count, and its 35-word windows are counted one by one.

Counts keep one row per hash and task, so very frequent passages do not gather anywhere. Hashes have
64 bits up to the last level but one, 128 at the last.

Defined cases: null text has no words; texts shorter than the window keep all; repeated rows are copies of
each other; a missing doc_id is a document of its own; other columns do no harm; empty tables give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats, seqhash

WINDOW = 35

_STRETCH = "doc long,mark long,base int,text string"
_BODY = "n long,doc long,mark long,low int,text binary"


def levels(window: int) -> list[int]:
    """Lengths of the levels before the last."""
    first = max(1, -(-window // 4))
    return [first, min(2 * first, window)]


def _stretches(texts: DataFrame, alive: DataFrame, window: int) -> DataFrame:
    """Maximal stretches of surviving windows, as text of their words joined by one space."""

    def cut(doc, mark, base, data, places):
        words = data.split()
        low, high = places.field("low").to_numpy() - base, places.field("high").to_numpy() - base
        order = np.argsort(low, kind="stable")
        low, high = low[order], high[order]
        inside = (low >= 0) & (high + window <= len(words))
        low, high = low[inside], high[inside]
        if not len(low):
            return [], [], [], []
        reach = np.maximum.accumulate(high)
        new = np.append(True, low[1:] > reach[:-1] + 1)
        first = low[new]
        last = reach[np.append(np.flatnonzero(new)[1:], len(low)) - 1]
        texts = [b" ".join(words[a : b + window]).decode() for a, b in zip(first, last, strict=True)]
        return [doc] * len(first), [mark] * len(first), (first + base).tolist(), texts

    return repeats.pieces(texts, alive.select("doc", "mark", "low", "high"), cut, _STRETCH)


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc, mark, spans (low, end): words covered by a window of ``window`` words that also starts elsewhere."""
    short, long = levels(window)
    texts = repeats.searched(docs)
    found = repeats.staged(repeats.runs(texts, repeats.words_of, window, short), "level1")
    alive = repeats.with_repeated_part(found)
    stretches = repeats.staged(_stretches(texts, alive, window), "stretches")
    found = repeats.staged(repeats.runs(stretches, repeats.words_of, window, long), "level2")
    alive = repeats.staged(repeats.with_repeated_part(found), "alive")
    distinct = repeats.staged(repeats.bodies(alive), "bodies")
    wanted = distinct.where("several").select("place.doc", "place.mark", "place.low", "place.high", "n")

    def cut(doc, mark, base, data, places):
        words = data.split()
        low, high, n = (places.field(k).to_numpy() for k in ("low", "high", "n"))
        inside = (low >= base) & (high + window <= base + len(words))
        low, high, n = low[inside], high[inside], n[inside]
        bodies = [b" ".join(words[a - base : b - base + window]) for a, b in zip(low, high, strict=True)]
        return n.tolist(), [doc] * len(low), [mark] * len(low), low.tolist(), bodies

    last = repeats.staged(repeats.pieces(stretches, wanted, cut, _BODY), "last")
    return repeats.whole_runs(alive, distinct, window).unionByName(repeats.single(_counted(last, window)))


def _counted(bodies: DataFrame, window: int) -> DataFrame:
    """Spans of windows of bodies that stand once, where the window stands in another body too."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, doc, mark, base = (batch[c].to_numpy() for c in ("n", "doc", "mark", "low"))
            for row, data, at in seqhash.slices(batch["text"]):
                starts, ends, before = seqhash.word_bounds(data, at)
                values = seqhash.word_hashes(data, starts, ends)
                one = seqhash.Rolling(values).every(window)
                two = seqhash.Rolling(seqhash.mix(values + np.uint64(1))).every(window)
                of = np.searchsorted(before, np.arange(len(one)), "right") - 1
                keep = np.arange(len(one)) + window <= before[np.minimum(of + 1, len(before) - 1)]
                of = of[keep]
                low = np.flatnonzero(keep) - before[of] + base[of + row]
                columns = [seqhash.signed(one[keep]), seqhash.signed(two[keep]), n[of + row], doc[of + row], mark[of + row], low.astype("i4")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["one", "two", "n", "doc", "mark", "low"])

    each = bodies.mapInArrow(windows, "one long, two long, n long, doc long, mark long, low int")
    twice = each.groupBy("one", "two").agg(F.sum("n").alias("stands")).where("stands > 1").select("one", "two")
    return (
        each.where("n = 1")
        .join(twice, ["one", "two"], "left_semi")
        .select("doc", "mark", "low", (F.col("low") + window).cast("int").alias("end"))
    )


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def window_dedup(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """Per document what stays: doc_id, n_words, n_removed, kept_sha256, and the ``kept`` words if asked for.

    With ``with_text`` the other columns of ``docs`` stay too; those named like the results are replaced by them.
    """
    spans = repeats.by_document(repeats.staged(repeated_spans(docs, window), "spans"))
    spans = spans.withColumnsRenamed({"doc": "_span_doc", "mark": "_span_mark", "spans": "_spans"})
    source = docs.drop("n_words", "n_removed", "kept_sha256", "kept") if with_text else docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    source = source.withColumns(dict(zip(("_span_doc", "_span_mark"), repeats._identity()[:2], strict=True)))
    joined = source.join(spans, ["_span_doc", "_span_mark"], "left").drop("_span_doc", "_span_mark")
    carried = [f for f in joined.schema.fields if f.name != "_spans"] if with_text else []

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch["text"], batch["_spans"], strict=True):
                words = (text.as_py() or "").encode().split()
                gone = repeats.covered(len(words), spans.values) if spans.is_valid else np.zeros(len(words), bool)
                kept = b" ".join(compress(words, ~gone))
                rows.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            own = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
            names = ["n_words", "n_removed", "kept_sha256", "kept"]
            if with_text:
                yield pa.RecordBatch.from_arrays([*(batch[f.name] for f in carried), *own], names=[*(f.name for f in carried), *names])
            else:
                yield pa.RecordBatch.from_arrays([batch["doc_id"], *own[:3]], names=["doc_id", *names[:3]])

    if not with_text:
        return joined.mapInArrow(remove, _RESULT)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)
    return joined.mapInArrow(remove, f"{schema}, n_words long, n_removed long, kept_sha256 string, kept string")
