"""Where windows of one document also stand elsewhere: the steps that suffix and window deduplication share.

Rows of documents are told apart by ``doc`` and ``mark``, two independent 64-bit hashes of the whole row identity (whether
there is a doc_id, the doc_id, the text), so that a repeated or missing doc_id does no harm; only rows equal in both
doc_id and text share them. However many such rows there are, two of them are searched, which finds what all would, and
all get the result. A run is a stretch of
neighbouring windows of one document that choose the same part (``seqhash.chosen``):
doc, mark, low (first start), high (last start), part and body (hashes of the part and of all its elements).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_through
from . import seqhash

RUN = "doc long, mark long, low int, high int, part long, body long"
Elements = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def identified(docs: DataFrame) -> DataFrame:
    """doc, mark and text of every document; no other column."""
    return docs.select(*_identity())


def searched(docs: DataFrame) -> DataFrame:
    """As ``identified``, with two rows of each group of more equal ones. Of those only hashes and a count travel, and one text per task."""
    texts = identified(docs)
    many = staged(texts.groupBy("doc", "mark").agg(F.count("*").alias("n")).where("n > 2").select("doc", "mark"), "equal")
    if many.isEmpty():
        return texts
    one = texts.join(many, ["doc", "mark"], "left_semi").groupBy("doc", "mark").agg(F.first("text").alias("text"))
    two = one.withColumn("_", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_")
    return texts.join(many, ["doc", "mark"], "left_anti").unionByName(staged(two, "two-of-equal"))


def _identity() -> list:
    text, doc_id = F.coalesce(F.col("text"), F.lit("")), F.col("doc_id").cast("long")
    of = lambda seed: F.xxhash64(F.lit(seed), doc_id.isNull(), doc_id, text)
    return [of(1).alias("doc"), of(2).alias("mark"), text.alias("text")]


def identified_with_id(docs: DataFrame) -> DataFrame:
    """As ``identified``, with the doc_id as it is."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select("doc_id", *_identity())


def bytes_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return seqhash.byte_values(data), at


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, before = seqhash.word_bounds(data, at)
    return seqhash.word_hashes(data, starts, ends), before


def runs(texts: DataFrame, elements: Elements, window: int, part: int) -> DataFrame:
    """All runs of ``texts`` (doc, mark, text and, if the text is a piece of a document, ``base``)."""
    based = "base" in texts.columns

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, mark = batch["doc"].to_numpy(zero_copy_only=False), batch["mark"].to_numpy(zero_copy_only=False)
            base = batch["base"].to_numpy(zero_copy_only=False) if based else None
            for row, data, at in seqhash.slices(batch["text"]):
                values, begins = elements(data, at)
                for of, low, high, key, body in seqhash.chosen(values, begins, window, part):
                    of = of + row
                    shift = base[of] if based else 0
                    columns = [doc[of], mark[of], (low + shift).astype("i4"), (high + shift).astype("i4"), seqhash.signed(key), seqhash.signed(body)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "mark", "low", "high", "part", "body"])

    return texts.mapInArrow(find, RUN)


def with_repeated_part(found: DataFrame) -> DataFrame:
    """Runs whose part some other run has too; ``several``: not all of them have the same body.

    Counting keeps one row per part and task. The counts are written, so that the join back reads two plain
    exchanges and can split a part that very many runs have.
    """
    parts = staged(
        found.groupBy("part")
        .agg(F.count("*").alias("n"), F.min("body").alias("least"), F.max("body").alias("most"))
        .where("n > 1")
        .select("part", (F.col("least") != F.col("most")).alias("several")),
        "parts",
    )
    return found.join(parts, "part")


def bodies(alive: DataFrame) -> DataFrame:
    """Each distinct body once: how often it stands, and the first place."""
    return alive.groupBy("part", "body").agg(
        F.count("*").alias("n"),
        F.min(F.struct("doc", "mark", "low", "high")).alias("place"),
        F.first("several").alias("several"),
    )


def whole_runs(alive: DataFrame, distinct: DataFrame, window: int) -> DataFrame:
    """doc, mark, spans of the runs whose body stands more than once: every window in them does.

    A part with one body has it in all of its runs, which are more than one. Only runs of the other parts are joined, as
    one row for each body in a document, so a line that stands very often in a document meets its count once.
    """
    span = F.struct("low", (F.col("high") + window).alias("end"))
    twice = distinct.where("several and n > 1").select("part", "body")
    own = alive.where("several").groupBy("doc", "mark", "part", "body").agg(F.collect_set(span).alias("spans"))
    joined = own.join(twice, ["part", "body"], "left_semi").select("doc", "mark", "spans")
    return alive.where("not several").select("doc", "mark", F.array(span).alias("spans")).unionByName(joined)


def single(spans: DataFrame) -> DataFrame:
    """Rows (doc, mark, low, end) as rows of one span each."""
    return spans.select("doc", "mark", F.array(F.struct("low", "end")).alias("spans"))


def by_document(spans: DataFrame) -> DataFrame:
    """All spans of a document in one row, those of equal rows once; bounded by the length of the document."""
    return spans.groupBy("doc", "mark").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def covered(length: int, spans) -> np.ndarray:
    """Which of ``length`` elements lie in a span."""
    edge = np.zeros(length + 1, np.int64)
    if spans is not None and len(spans):
        np.add.at(edge, spans.field("low").to_numpy(), 1)
        np.add.at(edge, spans.field("end").to_numpy(), -1)
    return np.cumsum(edge[:-1]) > 0


def pieces(texts: DataFrame, wanted: DataFrame, cut: Callable, schema: str) -> DataFrame:
    """What ``cut`` makes of each text that ``wanted`` names (doc, mark and other columns, as ``places``).

    ``texts`` has doc, mark, text and perhaps base. ``cut(doc, mark, base, text, places)`` gets one text as
    bytes and an Arrow struct array of its wanted places, and gives one list per column of ``schema``.
    """
    texts = texts if "base" in texts.columns else texts.withColumn("base", F.lit(0))
    others = [c for c in wanted.columns if c not in ("doc", "mark")]
    places = wanted.groupBy("doc", "mark").agg(F.collect_set(F.struct(*others)).alias("places"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in schema.split(",")]
            held = 0
            for doc, mark, base, text, of in zip(*(batch[c] for c in ("doc", "mark", "base", "text", "places")), strict=True):
                data = text.as_py().encode()
                for column, values in zip(rows, cut(doc.as_py(), mark.as_py(), base.as_py(), data, of.values), strict=True):
                    column.extend(values)
                held += len(data)
                if held > 8 * seqhash.SLICE:
                    yield _batch(rows, schema)
                    rows, held = [[] for _ in rows], 0
            yield _batch(rows, schema)

    return texts.join(places, ["doc", "mark"]).mapInArrow(take, schema)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "short": pa.int16(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _batch(rows: list[list], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(r, _TYPES[t]) for r, (_, t) in zip(rows, fields, strict=True)], names=[n for n, _ in fields])


def staged(df: DataFrame, name: str) -> DataFrame:
    return write_through(df, f"llm-{name}")
