"""The masks of decontamination against every substitution that the criterion allows, and whole rows."""

import random
from itertools import combinations

import numpy as np
import pytest

from wardgrid.llm import decontaminate
from wardgrid.llm.workers import importable


@pytest.fixture(scope="module")
def session(spark):
    return importable(spark)


def allowed(length):
    """All ways to substitute as many words as may differ, as bits."""
    differ = length * (100 - decontaminate.PERCENT) // 100
    return np.array([sum(1 << i for i in c) for c in combinations(range(length), differ)])


def missed(masks, length):
    left = allowed(length)
    for mask in masks:
        bits = sum(1 << i for i, b in enumerate(mask) if b == "1")
        for shift in range(length - len(mask) + 1):
            left = left[left & bits << shift != 0]
    return len(left)


@pytest.mark.parametrize("length", range(decontaminate.SHORTEST, 2 * decontaminate.LEAST))
def test_masks_hit_every_allowed_substitution(length):
    assert missed(decontaminate.MASKS if length >= decontaminate.LEAST else decontaminate.short_masks(length), length) == 0


def test_substituted_items_are_found(session):
    rng = random.Random(3)
    items = {n: [f"w{n}x{i}" for i in range(n)] for n in (5, 7, 10, 12, 13, 15, 16)}
    rows, wanted = [(0, "nothing of any item stands in this one")], set()
    for n, words in items.items():
        for k, out in enumerate(rng.sample(list(combinations(range(n), n // 5)), min(20, len(list(combinations(range(n), n // 5)))))):
            text = [f"z{k}" if i in out else w for i, w in enumerate(words)]
            rows.append((n * 1000 + k, " ".join(["before", *text, "after"])))
            wanted.add((n * 1000 + k, n))
    rows.append((16999, " ".join(w if i not in (4, 11) else "zzz" for i, w in enumerate(items[16]))))
    wanted.add((16999, 16))
    docs = session.createDataFrame(rows, "doc_id long, text string")
    benchmark = session.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated_documents(docs, benchmark).collect()} == wanted
    assert [r.doc_id for r in decontaminate.clean(docs, benchmark).collect()] == [0]
