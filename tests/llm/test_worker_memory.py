"""What a Python worker keeps between tasks, and how many rows meet, do not follow how long or how common texts are."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardgrid.llm import decontaminate, repeats, seqhash, window_dedup
from wardgrid.llm.workers import BATCH, importable


@pytest.fixture(scope="module")
def session(spark):
    return importable(spark)


def kept_bytes() -> int:
    return sum(x.nbytes for x in seqhash._POWERS)


def test_one_bounded_table_of_powers_stays(monkeypatch):
    monkeypatch.setattr(seqhash, "_POWERS", seqhash._NO_POWERS)
    for n in (1, 5000, 100_000, 700_000, 3_000_000, 70_000):
        up, down = seqhash._powers(n)
        assert len(up) >= n and len(down) >= n and (up[:n] * down[:n] == 1).all()
    assert kept_bytes() <= 16 * seqhash.KEPT


def test_words_are_hashed_alike_wherever_they_are_cut(monkeypatch):
    text = " ".join(f"w{i % 977}{'x' * (i % 40)}" for i in range(30_000)) + " " + "y" * 300_000 + " w1x"
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = seqhash.word_bounds(data, np.array([0, len(data)]))
    monkeypatch.setattr(seqhash, "_POWERS", seqhash._NO_POWERS)
    found = seqhash.word_hashes(data, starts, ends)
    assert kept_bytes() <= 16 * seqhash.SLICE * 2
    whole = seqhash.Rolling(seqhash.byte_values(data)).stretch(starts, ends)
    assert (found == whole).all() and len(np.unique(found)) == len(set(text.split()))


def test_batches_are_bounded_by_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    own = spark.newSession()
    own.conf.set(BATCH[0], "3m")
    assert importable(own).conf.get(BATCH[0]) == "3m"
    rows = importable(spark.newSession()).range(0, 12_000, 1, 1).select(F.repeat(F.lit("abcdefgh"), 400).alias("text"))
    found = rows.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r["n"] for r in found) == 12_000 and max(r["bytes"] for r in found) < 9 << 20


def test_a_bit_for_each_seed(session):
    seeds = [0, 1, -1, 1 << 62, -(1 << 63), 12345678901234567, -98765432109876543]
    bits = decontaminate._bitmap(session.createDataFrame([(s,) for s in seeds], "seed long"))
    assert bits.nbytes == 1 << (decontaminate.BITMAP_BITS - 3)
    assert decontaminate._in_bitmap(bits, np.array(seeds).view(np.uint64)).all()
    others = seqhash.mix(np.arange(1, 100_000, dtype=np.uint64))
    slots = set((np.array(seeds).view(np.uint64) >> np.uint64(64 - decontaminate.BITMAP_BITS)).tolist())
    want = [int(x) >> (64 - decontaminate.BITMAP_BITS) in slots for x in others]
    assert decontaminate._in_bitmap(bits, others).tolist() == want


def test_runs_that_are_joined_to_counts(session):
    """One row for each body in a document, and none of a part with one body."""
    rows = [(i, i, 0, 9, 1, 11) for i in range(500)]
    rows += [(1000, 1, 3 * i, 3 * i + 2, 2, 21) for i in range(400)] + [(1002, 1, 0, 5, 2, 22)]
    rows += [(2000, 1, 0, 5, 3, 31)]
    alive = repeats.with_repeated_part(session.createDataFrame(rows, repeats.RUN))
    distinct = repeats.bodies(alive)
    found = repeats.whole_runs(alive, distinct, 35)
    assert found.where("doc >= 1000").count() == 1
    spans = {r["doc"]: sorted(tuple(s) for s in r["spans"]) for r in repeats.by_document(found).collect()}
    assert spans == {i: [(0, 44)] for i in range(500)} | {1000: [(3 * i, 3 * i + 37) for i in range(400)]}
    without_counts = repeats.whole_runs(alive, distinct.limit(0), 35)
    assert sorted(r["doc"] for r in without_counts.collect()) == list(range(500))


def test_many_spans_of_a_document_take_time_in_proportion(session):
    """150,000 spans of one document, each from both of two equal rows, come once and without comparing each with each."""
    spans = session.range(300_000).selectExpr("1L as doc", "2L as mark", "cast(id % 150000 as int) as low", "cast(id % 150000 + 35 as int) as end")
    began = time.monotonic()
    assert repeats.by_document(repeats.single(spans)).select(F.size("spans")).collect() == [(150_000,)]
    assert time.monotonic() - began < 30


def test_common_passage_is_removed_from_every_document(session):
    passage = " ".join(f"p{i}" for i in range(60))
    own = lambda i, k: " ".join(f"d{i}x{j}y{k}" for j in range(20))
    rows = [(i, f"{own(i, 0)} {passage} {own(i, 1)}") for i in range(300)] + [(500, passage), (501, own(7, 2)), (502, None)]
    docs = session.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = {r["doc_id"]: r for r in window_dedup.window_dedup(docs).select("doc_id", "n_words", F.col("n_removed").alias("gone")).collect()}
    assert all(tuple(found[i])[1:] == (100, 60) for i in range(300))
    assert tuple(found[500])[1:] == (60, 60) and tuple(found[501])[1:] == (20, 0) and tuple(found[502])[1:] == (0, 0)
