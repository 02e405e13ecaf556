"""A bounded sample of labelled texts to learn from, without sending texts of every task to the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Longest text, in bytes of UTF-8, that a model learns from; so a sample's bytes are bounded.
LONGEST = 1 << 14


def least(rows: DataFrame, number: int) -> DataFrame:
    """The ``number`` least distinct values of ``rows`` (at, a long). Each task hands on no more than that many."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, np.int64)
        for batch in batches:
            held = np.unique(np.concatenate([held, batch["at"].to_numpy(zero_copy_only=False)]))[:number]
        yield pa.RecordBatch.from_arrays([pa.array(held)], names=["at"])

    return rows.select("at").mapInArrow(cut, "at long").distinct().orderBy("at").limit(number)


def texts_of(docs: DataFrame, chosen: DataFrame, order: list) -> DataFrame:
    """One row of ``docs`` (with ``at`` and ``text``) per value of ``chosen``, at most a sample's number: the first by ``order``."""
    met = docs.where(F.octet_length("text") <= LONGEST).join(F.broadcast(chosen), "at")
    # the rank is cut in every map task, so many rows with one value do not meet
    first = F.row_number().over(Window.partitionBy("at").orderBy(*order))
    return met.withColumn("_rank", first).where("_rank = 1").drop("_rank")
