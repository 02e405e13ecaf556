"""Fingerprints and the next document against plain loops; repeated and missing doc_ids in number."""

import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardgrid.llm import seqhash, simhash
from wardgrid.llm.workers import importable


@pytest.fixture(scope="module")
def session(spark):
    return importable(spark)


def plain_print(text):
    """Votes bit by bit, with the library's word hashes only."""
    data, at = next((d, a) for _, d, a in seqhash.slices(pa.array([text], pa.large_string())))
    data = seqhash.lower_ascii(data)
    starts, ends, _ = seqhash.word_bounds(data, at)
    words = seqhash.word_hashes(data, starts, ends)
    terms = Counter()
    weight = {}
    for i, w in enumerate(words.tolist()):
        terms[w] += 1
        weight[w] = 2.0 if ends[i] - starts[i] > 3 else 1.0
    for one, two in zip(words[:-1], words[1:], strict=True):
        pair = int(seqhash.mix(np.array([one]) * np.uint64(3) + np.array([two]))[0])
        terms[pair] += 1
        weight[pair] = 3.0
    votes = [0.0] * simhash.BITS
    for term, count in terms.items():
        for bit in range(simhash.BITS):
            half = int(seqhash.mix(np.array([term], np.uint64) + np.uint64(bit // 64))[0])
            votes[bit] += (1 if half >> (bit % 64) & 1 else -1) * math.sqrt(count) * weight[term]
    out = bytearray(simhash.BITS // 8)
    for bit, vote in enumerate(votes):
        if vote > 1e-9:
            out[bit // 8] |= 1 << (bit % 8)
    return out.hex()


def expected(rows):
    """(doc_id, text) to the multiset of (doc_id, n_chars, edited hash), in the operator's order."""
    def key(r):
        return (r[0] is None, -(r[0] or 0), r[2], r[1])

    order = sorted(((d, t or "", h) for d, t, h in rows), key=key)
    out = Counter()
    for one, two in zip(order, order[1:] + order[:1], strict=True):
        half = len(one[1]) // 2
        edited = one[1][: len(one[1]) - half] + two[1][:half]
        out[(one[0], len(one[1]), hashlib.sha256(edited.encode()).hexdigest())] += 1
    return out


def result(frame):
    return Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in frame.collect())


def hashed(session, rows):
    frame = session.createDataFrame(rows, "doc_id long, text string")
    return frame, [(r.doc_id, r.text, r.h) for r in frame.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()]


@pytest.mark.parametrize("text", ["", "word", "A b a B a b", "the cat sat on the cat mat the end", "ñandú Ñandú x1 " * 7])
def test_fingerprint_is_the_sign_of_votes(session, text):
    [row] = simhash.edited_fingerprints(session.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.fingerprint == plain_print(text)


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_hot_doc_ids_keep_the_order(session, blocks):
    """A third of the rows without doc_id, a third with one doc_id, and many equal rows of both."""
    rows = [(None, f"none {i} " * 3) for i in range(60)] + [(7, f"seven {i} x" * 2) for i in range(60)]
    rows += [(i, f"text {i} and more") for i in range(-30, 30)] + [(None, "the same text " * 4)] * 25 + [(7, "seven again " * 4)] * 25 + [(3, None)] * 4
    frame, with_hash = hashed(session, rows)
    assert result(simhash.edited_fingerprints(frame, blocks)) == expected(with_hash)


def test_no_task_holds_a_hot_doc_id(session):
    rows = [(None, f"none {i}") for i in range(2000)] + [(5, f"five {i}") for i in range(2000)] + [(i, f"t {i}") for i in range(2000)]
    rows += [(9, "equal row")] * 3000
    dealt = simhash._dealt(session.createDataFrame(rows, "doc_id long, text string"), 30)
    sizes = [r["count"] for r in dealt.groupBy("block").count().collect()]
    assert max(sizes) < 600 and dealt.where("borrowed").count() == len(sizes)
    assert dealt.where("not borrowed").agg(F.sum("times")).first()[0] == len(rows)


def test_all_rows_equal_and_single_rows(session):
    for rows in ([(None, "a b c d")] * 5, [(4, "x y")] * 2, [(4, "only one")], [(1, None)], [(1, ""), (None, "")]):
        frame, with_hash = hashed(session, rows)
        assert result(simhash.edited_fingerprints(frame, 8)) == expected(with_hash)
