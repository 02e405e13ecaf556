"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader updates.

A word is a run of letters, of digits or of other signs (ASCII letters lower-cased); features are words and
pairs of neighbouring words, and that a word equals the one before it or the one before that, hashed to ``DIMENSIONS``, weighted by the square root of their count and scaled
to length one. The model is fitted on at most ``SAMPLE`` labels (those with the least hash of doc_id and label), with one document of at
most ``sampling.LONGEST`` bytes each, document by document, with per-coordinate rates; scoring is one sparse dot product per document.

Defined cases: null and empty texts have no features and get the score of the intercept; rows without a label
are only scored; without any label every score is 1; repeated rows score alike; columns named like the
results are replaced by them; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sampling, seqhash

DIMENSIONS, SAMPLE, EPOCHS, THRESHOLD = 1 << 18, 4000, 3, 0.3
#: Labels to learn from; the rest is held out.
LEARN = "crc32(cast(doc_id as string)) % 5 <> 0"
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-3

_U = np.uint64
_AGAIN, _SKIPPED = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)


def _kinds() -> np.ndarray:
    kind = np.full(256, 3, np.uint8)
    kind[128:] = 1
    kind[[*range(65, 91), *range(97, 123)]] = 1
    kind[48:58] = 2
    kind[[32, *range(9, 14)]] = 0
    return kind


_KIND = _kinds()


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and how many words lie before each text."""
    data = seqhash.lower_ascii(data)
    kind = _KIND[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[at] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    full = kind[starts] != 0
    starts, ends = starts[full], ends[full]
    return seqhash.word_hashes(data, starts, ends), np.searchsorted(starts, at)


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, coordinate, value) of all features, in order of text and coordinate."""
    hashes, before = words(data, at)
    of = np.repeat(np.arange(len(at) - 1), np.diff(before))
    pairs = np.flatnonzero(of[1:] == of[:-1])
    threes = np.flatnonzero(of[2:] == of[:-2])
    again, skipped = pairs[hashes[pairs] == hashes[pairs + 1]], threes[hashes[threes] == hashes[threes + 2]]
    both = np.concatenate([hashes, seqhash.mix(hashes[pairs] * _U(5) + hashes[pairs + 1]), np.full(len(again), _AGAIN), np.full(len(skipped), _SKIPPED)])
    cell = np.concatenate([of, of[pairs], of[again], of[skipped]]) * DIMENSIONS + (both >> _U(64 - 18)).astype(np.int64)
    cell, count = np.unique(cell, return_counts=True)
    text, value = cell // DIMENSIONS, np.sqrt(count)
    norm = np.sqrt(np.bincount(text, weights=value * value, minlength=len(at) - 1))
    return text, cell % DIMENSIONS, value / norm[text]


def fit(texts: list[str], labels: list[int]) -> tuple[np.ndarray, float] | None:
    """Weights and intercept after ``EPOCHS`` passes in the given order."""
    if not texts:
        return None
    rows = []
    for _, data, at in seqhash.slices(pa.array(texts, pa.large_string())):
        text, where, value = features(data, at)
        cuts = np.searchsorted(text, np.arange(len(at)))
        rows += [(where[a:b], value[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)  # the last coordinate is the intercept
    for _ in range(EPOCHS):
        for (where, value), label in zip(rows, labels, strict=True):
            where, value = np.append(where, DIMENSIONS), np.append(value, 1.0)
            weight = _weights(z[where], n[where])
            error = 1 / (1 + np.exp(-np.clip(weight @ value, -35, 35))) - label
            step = error * value
            z[where] += step - (np.sqrt(n[where] + step * step) - np.sqrt(n[where])) / ALPHA * weight
            n[where] += step * step
    weight = _weights(z, n)
    return weight[:-1], float(weight[-1])


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def training_rows(docs: DataFrame, labels: DataFrame, learn: str, sample: int = SAMPLE) -> DataFrame:
    """(at, text, quality) of at most ``sample`` labels, one row of documents each; the labels are broadcast, being that few."""
    known = labels.where(learn).where("quality is not null and doc_id is not null")
    known = known.select("doc_id", "quality", F.xxhash64(F.col("doc_id"), F.lit("quality"), F.col("quality").cast("int")).alias("at"))
    chosen = known.join(F.broadcast(sampling.least(known, sample)), "at", "left_semi").distinct()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return sampling.texts_of(texts.join(F.broadcast(chosen), "doc_id"), chosen.select("at"), [F.xxhash64("text"), "text"])


def score(docs: DataFrame, labels: DataFrame, learn: str = "true", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with the columns score (likelihood of label 1) and predicted; ``learn`` is the SQL condition of labels to use."""
    rows = sorted(training_rows(docs, labels, learn, sample).collect(), key=lambda r: r["at"])
    model = fit([r["text"] for r in rows], [int(r["quality"]) for r in rows])
    docs = docs.drop("score", "predicted")
    carried = docs.schema.fields

    def dot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.ones(batch.num_rows)
            for row, data, at in seqhash.slices(batch["text"]) if model is not None else ():
                text, where, value = features(data, at)
                raw = np.bincount(text, weights=value * model[0][where], minlength=len(at) - 1) + model[1]
                found[row : row + len(at) - 1] = 1 / (1 + np.exp(-np.clip(raw, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found), pa.array((found >= THRESHOLD).astype("i4"))], names=[*batch.schema.names, "score", "predicted"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)
    return docs.mapInArrow(dot, f"{schema}, score double, predicted int")
