"""The stages that keep one of each group and then remove repeated passages, on repeated rows and missing ids."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from wardgrid.llm import hyperminhash, tokens
from wardgrid.llm.workers import importable

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, more string"


@pytest.fixture(scope="module")
def session(spark):
    return importable(spark)


def texts(n, words=60):
    rng = random.Random(12)
    return [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(words)) for _ in range(n)]


def near(text):
    return text + " end"


def table(session, rows):
    return session.createDataFrame([(i, t, lang, "s", len(t or ""), "m") for i, t, lang in rows], SCHEMA).repartition(3)


def stages(session, docs):
    kept = corpus_pipeline.keep_one_of_near_duplicates(session, docs, "")
    return kept, corpus_pipeline.remove_repeated_passages(session, kept, "")


def test_one_row_of_each_group_stays(session):
    a, b, c, d, e = texts(5)
    rows = [(1, a, "en"), (1, a, "en"), (1, a, "de"), (1, near(a), "en")]  # repeated rows, a near copy with the same doc_id
    rows += [(None, b, "en"), (None, b, "en"), (None, near(b), "en")]  # a group without any doc_id
    rows += [(None, c, "en"), (4, near(c), "en"), (3, c, "en")]  # one that has some
    rows += [(None, d, "en"), (3, e, "en"), (None, None, "en"), (8, " ", "en"), (8, " ", "en")]
    docs = table(session, rows)
    kept, cut = stages(session, docs)
    rest = [(None, None), (8, " "), (8, " ")]
    found = sorted(((r.doc_id, r.text, r.lang) for r in kept.collect()), key=repr)
    name = {t.split()[0]: n for n, t in zip("abcde", (a, b, c, d, e), strict=True)}
    heads = [(i, name[t.split()[0]]) for i, t, _ in found if (i, t) not in rest]
    assert sorted(heads, key=repr) == sorted([(1, "a"), (None, "b"), (3, "c"), (None, "d"), (3, "e")], key=repr)
    assert (3, c, "en") in found and len(found) == 5 + len(rest)
    # nothing is repeated any more, so the next stage keeps every text
    assert sorted(((r.doc_id, r.text, r.lang) for r in cut.collect()), key=repr) == found
    marked = [r.chosen for r in hyperminhash.near_duplicates(docs, shingle=5).collect()]
    assert len(marked) == len(rows) and sum(marked) == len(found)


def test_equal_rows_beyond_one_array(session, monkeypatch):
    monkeypatch.setattr(hyperminhash, "EQUAL", 3)
    (a,) = texts(1)
    for n in (1, 3, 4, 10):
        found = hyperminhash.near_duplicates(table(session, [(5, a, "en")] * n)).collect()
        assert len(found) == n and sum(r.chosen for r in found) == 1


def test_stages_of_an_empty_table(session):
    for df in stages(session, table(session, [(1, "a b", "en")]).limit(0)):
        assert df.columns == corpus_pipeline.COLUMNS and df.count() == 0


def test_run_equals_plain_versions_of_its_stages(session, tmp_path):
    """Junk, copies, near copies, a shared passage, a benchmark item, odd rows, extra columns: what stays is packed piece by piece."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    a, b, c, d, e, f, g = texts(7)
    passage, item = (" ".join(word() for _ in range(n)) for n in (40, 20))
    good = {i: " ".join(word() for _ in range(50)) for i in range(200, 240)}
    junk = {i: "buy now " * rng.randint(20, 40) + word() for i in range(300, 340)}
    rows = [(1, a), (2, a), (3, near(a)), (None, b), (None, b), (5, None), (6, ""), (7, "\t "), (8, f"{c} {passage}"), (9, f"{passage} {d}")]
    rows += [(10, f"{e} {item} {g}"), (11, f), (12, "z " * 9000), *good.items(), *junk.items()]
    table(session, [(i, t, "en") for i, t in rows]).write.parquet(str(tmp_path / "documents.parquet"))
    marks = [(i, 1, 0) for i in good] + [(i, 0, 0) for i in junk]
    session.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    session.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    want = [(1, a), (None, b), (5, ""), (6, ""), (7, "\t "), (8, c), (9, d), (11, f), *good.items()]  # of 12 all windows repeat
    want.append((12, ""))
    tokenizer = Tokenizer.from_file(tokens.default_path())
    pieces = []
    for i, text in want:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        pieces += [(repr(i), len(p), zlib.crc32(np.array(p, "<u4"))) for p in (ids[low : low + 4096] for low in range(0, len(ids), 4096))]
    found = corpus_pipeline.run(session, str(tmp_path)).collect()
    assert sorted((repr(r.doc_id), r.length, r.ids_crc32) for r in found) == sorted(pieces)
    filled = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 4096 and len(filled) == -(-sum(p[1] for p in pieces) // 4096)
