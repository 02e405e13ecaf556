"""What the driver learns from is bounded; flags and hidden elements keep to their contracts."""

import pytest
from pyspark.sql import functions as F

from wardgrid.llm import html_blocks, hyperminhash, language, quality, sampling
from wardgrid.llm.workers import importable


@pytest.fixture(scope="module")
def session(spark):
    return importable(spark)


def test_least_values_of_many_tasks(session):
    values = [(x * 7919 % 1000 - 500,) for x in range(3000)]
    rows = session.createDataFrame(values, "at long").repartition(23)
    assert [r["at"] for r in sampling.least(rows, 17).collect()] == sorted({v for v, in values})[:17]
    assert sampling.least(rows.limit(0), 5).collect() == []


def test_language_learns_from_one_row_per_id_and_bounded_texts(session):
    rows = [(1, "abc " * 20, "en")] * 4000 + [(None, "xyz", "fr")] * 500 + [(i, f"text {i}", "en") for i in range(10, 60)]
    rows += [(2, "long " * 5000, "en"), (3, None, "en"), (4, "no language", None)]
    docs = session.createDataFrame(rows, "doc_id long, text string, lang string").repartition(9)
    found = language.training_rows(docs, "true", sample=40).collect()
    assert len(found) == len({r["at"] for r in found}) <= 40
    everything = language.training_rows(docs, "true", sample=1000).collect()
    assert len(everything) == 52 and max(len(r["text"]) for r in everything) < sampling.LONGEST


def test_quality_learns_from_one_row_per_label(session):
    docs = session.createDataFrame([(1, "same")] * 5000 + [(2, None), (3, "x" * 40_000), (4, "four")], "doc_id long, text string").repartition(9)
    labels = session.createDataFrame([(1, 1), (1, 1), (1, 0), (2, 0), (3, 1), (4, None), (None, 1), (9, 1)], "doc_id long, quality int")
    found = quality.training_rows(docs, labels, "true").collect()
    assert sorted((r["text"], r["quality"]) for r in found) == [("", 0), ("same", 0), ("same", 1)]


def test_kept_is_having_the_least_doc_id(session):
    text = "one two three four five six seven"
    rows = [(5, text), (5, text), (6, text), (None, text), (7, ""), (None, "alone words here"), (None, "alone words here"), (8, None)]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    found = sorted((repr(r.doc_id), repr(r.component_id), r.kept, r.chosen) for r in hyperminhash.near_duplicates(docs).collect())
    want = [("5", "5", True, False), ("5", "5", True, True), ("6", "5", False, False), ("7", "7", True, True), ("8", "8", True, True)]
    assert found == sorted([*want, ("None", "5", False, False), ("None", "None", True, True), ("None", "None", True, False)])


@pytest.mark.parametrize(
    ("html", "texts"),
    [
        ("<p>Let <math>x=2</math> hold.</p>", ["Let x=2 hold."]),
        ("<p>A <object>fallback</object> <svg><text>drawn</text></svg></p>", ["A fallback drawn"]),
        ("<p>A<video>no video</video></p><noscript><p>plain</p></noscript>", ["Ano video", "plain"]),
        ("<p>one <title>lost</p><p>two</p><p>three <title>lost too</p>four", ["one", "two", "three", "four"]),
        ("<p>one <iframe>two</p><p>three</p>", ["one two", "three"]),
        ("<p>a<script>if (1 < 2) x</script>b<style>p {}</style></p><template><p>c</p></template><p>d</p>", ["ab", "d"]),
        ("<p>a <script>never closed", ["a"]),
        ("", []),
    ],
)
def test_only_scripts_styles_templates_and_titles_are_hidden(html, texts):
    assert [b.text for b in html_blocks.blocks(html)] == texts


def test_many_unclosed_elements_take_time_in_proportion():
    page = "<p>x <script>y</p>" * 20_000
    assert len(html_blocks.blocks(page)) == 20_000
