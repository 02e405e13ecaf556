"""Many different texts without a doc_id, or with one and the same, are documents of their own."""

import random

import pytest
from llm.test_operators import by_bytes, by_words, plain

from wardgrid.llm import arrow_ids, decontaminate, repeats, suffix_dedup, window_dedup
from wardgrid.llm.workers import importable


@pytest.fixture(scope="module")
def rows():
    """Every second text holds the same passage."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=7))
    passage = " ".join(word() for _ in range(36))
    return [(None if n % 4 < 2 else 7, f"{word()} {passage} {word()}" if n % 2 else " ".join(word() for _ in range(38))) for n in range(3000)]


@pytest.fixture(scope="module")
def shared(spark, rows):
    return importable(spark).createDataFrame(rows, "doc_id long, text string").repartition(8)


def test_windows_of_shared_ids(shared, rows):
    assert plain(window_dedup.window_dedup(shared)) == by_words(rows)


def test_suffixes_of_shared_ids(shared, rows):
    assert plain(suffix_dedup.suffix_dedup(shared)) == by_bytes(rows)


def test_contamination_of_shared_ids(shared, rows):
    passage = " ".join(rows[1][1].split()[1:-1])
    items = shared.sparkSession.createDataFrame([(1, passage)], "item_id long, text string")
    assert plain(decontaminate.clean(shared, items)) == sorted((r for n, r in enumerate(rows) if n % 2 == 0), key=repr)
    assert decontaminate.contaminated_documents(shared, items).count() == len(rows) // 2


@pytest.mark.parametrize("find", [suffix_dedup.repeated_spans, window_dedup.repeated_spans])
def test_spans_do_not_grow_with_equal_rows(spark, find):
    """Thousands of rows equal in doc_id and text give the spans that three give, and are joined with them once."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    text, other, shared = (" ".join(word() for _ in range(300)) for _ in range(3))
    counts, results = [], []
    for n in (3, 3000):
        rows = [(None, text)] * n + [(1, f"{other} {shared}"), (2, f"{shared} {text}"), (3, other[:900])]
        docs = importable(spark).createDataFrame(rows, "doc_id long, text string").repartition(7)
        spans = repeats.by_document(find(docs)).collect()
        counts.append(sum(len(r.spans) for r in spans))
        results.append(sorted((r.doc, sorted(map(tuple, r.spans))) for r in spans))
        dedup = suffix_dedup.suffix_dedup if find is suffix_dedup.repeated_spans else window_dedup.window_dedup
        found = [r for r in dedup(docs).collect() if r.doc_id is None]
        assert len(found) == n and len({tuple(r) for r in found}) == 1 and found[0].n_removed == found[0][1]
    assert counts[0] == counts[1] and results[0] == results[1]


def test_arrow_ids_deals_rows_without_an_id(spark):
    """Different texts with one or no doc_id go to many files; all are read back, in the order of ids."""
    rows = [(None, f"text {i}") for i in range(3000)] + [(7, f"more {i}") for i in range(3000)] + [(8, "last")]
    docs = importable(spark).createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder = arrow_ids.new_folder(spark, "ids")
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # else so few rows go to one task
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        files = arrow_ids.write_ids(docs, folder)
    finally:
        spark.conf.set(key, old)
    assert files.count() > 3 and files.agg({"documents": "max"}).first()[0] < 3000
    found = arrow_ids.read_ids(files, folder).collect()
    found.sort(key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None] * 3000 + [7] * 3000 + [8]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:], strict=False))
