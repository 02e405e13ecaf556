"""Language identification with blended-spectrum string kernels.

A text is the set of its n-grams of 1 to 3 letters (Unicode letters, lower-cased; any other stretch is one
space), hashed to ``DIMENSIONS``. The kernel of two texts is the number of n-grams present in both, divided by
the geometric mean of their sizes. ``LANDMARKS`` training texts span the Nystroem space; a kernel ridge
regression in it, one against the rest, gives one column of weights per language. A batch of texts is scored by two matrix products.

Learned from at most ``SAMPLE`` labelled texts of at most ``sampling.LONGEST`` bytes (those with the least hash of doc_id, one per doc_id);
everything else covers all rows. Hashes are chosen first; only the texts of the chosen ones reach the driver.

Defined cases: a text that is null or has no letter is ``und`` with score 0; without any labelled text all are;
repeated rows are predicted alike; other columns do no harm; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sampling, seqhash

DIMENSIONS, ORDERS = 1 << 14, 3
LANDMARKS, SAMPLE, RIDGE = 192, 3000, 1e-2

_OTHER = regex.compile(r"[^\p{L}]+")
_U = np.uint64
_BATCH = 128


def presence(texts: list[str | None]) -> np.ndarray:
    """One row per text: 1 for each hashed n-gram it has, scaled to length one."""
    rows = np.zeros((len(texts), DIMENSIONS), np.float32)
    for low, part in _parts([_OTHER.sub(" ", t or "").strip().lower() for t in texts]):
        points = [np.frombuffer(f" {t} ".encode("utf-32-le"), np.uint32).astype(_U) for t in part]
        of = np.repeat(np.arange(len(part)), [len(p) for p in points])
        codes = np.concatenate(points)
        key = np.zeros(len(codes), _U)
        for order in range(1, ORDERS + 1):
            n = len(codes) - order + 1
            key = key[:n] * _U(0x110000) + codes[order - 1 :]
            inside = of[:n] == of[order - 1 :]
            cell = (seqhash.mix(key * _U(4) + _U(order)) >> _U(50)).astype(np.int64)
            rows[low + of[:n][inside], cell[inside]] = 1
    return rows / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))


def _parts(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    low = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > seqhash.SLICE or i + 1 == len(texts):
            yield low, texts[low : i + 1]
            low, size = i + 1, 0


class Model:
    def __init__(self, languages: list[str], landmarks: np.ndarray, weights: np.ndarray, constant: np.ndarray):
        self.languages, self.landmarks, self.weights, self.constant = languages, landmarks, weights, constant

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return (presence(texts) @ self.landmarks.T) @ self.weights + self.constant


def fit(texts: list[str], languages: list[str]) -> Model | None:
    """Kernel ridge regression in the Nystroem space of some of the texts, as many of each language as there are."""
    names = sorted(set(languages))
    if not names:
        return None
    label = np.array([names.index(x) for x in languages])
    each = -(-LANDMARKS // len(names))
    landmarks = presence([texts[i] for i in np.concatenate([np.flatnonzero(label == k)[:each] for k in range(len(names))])])
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    project = vectors[:, keep] / np.sqrt(values[keep])
    near = np.concatenate([presence(texts[i : i + _BATCH]) @ landmarks.T for i in range(0, len(texts), _BATCH)])
    features = np.hstack([near @ project, np.ones((len(texts), 1))])
    target = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    share = np.bincount(label, minlength=len(names)) / len(label)
    weight = (1 / share / len(names))[label][:, None]  # rare languages count as much as common ones
    gram = features.T @ (features * weight)
    solved = np.linalg.solve(gram + RIDGE * np.eye(len(gram)), features.T @ (target * weight))
    return Model(names, landmarks, (project @ solved[:-1]).astype(np.float32), solved[-1])


def training_rows(docs: DataFrame, learn: str, sample: int = SAMPLE) -> DataFrame:
    """(text, lang) of at most ``sample`` labelled texts, one per doc_id, chosen by a hash of doc_id that no content enters."""
    known = docs.where(learn).where("lang is not null").where(F.octet_length("text") <= sampling.LONGEST)
    known = known.select(F.xxhash64(F.col("doc_id"), F.lit("language")).alias("at"), "text", "lang")
    return sampling.texts_of(known, sampling.least(known, sample), ["lang", F.xxhash64("text"), "text"])


def identify(docs: DataFrame, learn: str = "true", sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, lang_pred, score; ``learn`` is the SQL condition of rows to learn from."""
    rows = sorted(training_rows(docs.select("doc_id", "text", "lang"), learn, sample).collect(), key=lambda r: r["at"])
    rows = [r for r in rows if _letters(r["text"])]
    model = fit([r["text"] for r in rows], [r["lang"] for r in rows])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_predict(model), "doc_id long, lang_pred string, score double")


def _letters(text: str | None) -> bool:
    return text is not None and regex.search(r"\p{L}", text) is not None


def _predict(model: Model | None) -> Callable:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, _BATCH):
                part = batch.slice(low, _BATCH)
                texts = part["text"].to_pylist()
                names, scores = ["und"] * len(texts), np.zeros(len(texts))
                if model is not None:
                    found = model.scores(texts)
                    best = found.argmax(axis=1)
                    even = np.exp(4 * (found - found.max(axis=1, keepdims=True)))
                    sure = even.max(axis=1) / even.sum(axis=1)
                    for i, text in enumerate(texts):
                        if _letters(text):
                            names[i], scores[i] = model.languages[best[i]], sure[i]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(names), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return predict
