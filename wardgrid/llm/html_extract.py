"""Main text of web pages: a recurrent labeller of blocks.

A page is a sequence of blocks (``html_blocks``). Each block is a vector of its hashed tag path (element and class
names), its hashed words, and how long and how linked it is. A bidirectional LSTM reads the whole sequence,
so that every block is judged in the light of the document; blocks above one half are the main text.

The network is small, written in numpy, and trained here on labelled pages that rules make (``made_pages``, a fixed
seed), once per driver process. Pages of similar length are read side by side, in batches of bounded size.

Defined cases: null or empty html gives the empty text; broken markup is read as far as it goes; repeated rows
give the same text; other columns do no harm; empty tables give no rows.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import made_pages, seqhash
from .html_blocks import Block, blocks

PATH, WORDS, HIDDEN = 256, 16, 12
INPUTS = PATH + WORDS + 3
PAGES, EPOCHS, TOGETHER, RATE, SEED = 1600, 5, 16, 0.01, 7
#: Blocks of all pages in one batch, padding included.
BATCH_BLOCKS = 20_000

_U = np.uint64
_TEXT = re.compile(r">(?=[^<\s])")


@cache
def _slot(label: str) -> int:
    return int(seqhash.Rolling(seqhash.byte_values(np.frombuffer(label.encode(), np.uint8))).every(len(label.encode()))[0] >> _U(56))


def vectors(found: list[Block]) -> np.ndarray:
    out = np.zeros((len(found), INPUTS), np.float32)
    paths: dict[tuple[str, ...], np.ndarray] = {}
    for i, b in enumerate(found):
        if b.path not in paths:
            paths[b.path] = row = np.zeros(PATH, np.float32)
            for label in b.path:
                row[_slot(label)] = 1
        out[i, :PATH] = paths[b.path]
        out[i, PATH + WORDS] = np.log1p(len(b.text)) / 5
        out[i, PATH + WORDS + 1] = b.linked
    out[:, -1] = 1
    texts = [b.text.encode() for b in found]
    data = np.frombuffer(b" ".join(texts), np.uint8)
    at = np.append(0, np.cumsum([len(t) + 1 for t in texts]))
    at[-1] = len(data)
    starts, ends, before = seqhash.word_bounds(data, at)
    of = np.repeat(np.arange(len(found)), np.diff(before))
    cell = of * WORDS + (seqhash.word_hashes(data, starts, ends) >> _U(60)).astype(np.int64)
    counts = np.bincount(cell, minlength=len(found) * WORDS).reshape(-1, WORDS)
    out[:, PATH : PATH + WORDS] = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs, one from each end, and a logistic output over both."""

    def __init__(self, rng: np.random.Generator):
        normal = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.weights = [normal(INPUTS, 4 * HIDDEN), normal(HIDDEN, 4 * HIDDEN), normal(INPUTS, 4 * HIDDEN), normal(HIDDEN, 4 * HIDDEN), normal(2 * HIDDEN + 1, 1)]

    def _run(self, x: np.ndarray, mask: np.ndarray, way: int) -> tuple[np.ndarray, list]:
        """States of one direction; x is (blocks, pages, inputs)."""
        inputs, again = self.weights[2 * way], self.weights[2 * way + 1]
        given = x @ inputs
        pages = x.shape[1]
        h = c = np.zeros((pages, HIDDEN), np.float32)
        states, kept = np.zeros((*x.shape[:2], HIDDEN), np.float32), []
        steps = range(len(x)) if way == 0 else range(len(x) - 1, -1, -1)
        for t in steps:
            gates = given[t] + h @ again
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN] + (k == 1)) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            kept.append((t, h, c, i, f, o, g, tanh_c, m))
            h, c = m * o * tanh_c + (1 - m) * h, m * new_c + (1 - m) * c
            states[t] = h
        return states, kept

    def forward(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
        runs = [self._run(x, mask, way) for way in (0, 1)]
        both = np.concatenate([runs[0][0], runs[1][0], np.ones((*x.shape[:2], 1), np.float32)], axis=2)
        return _sigmoid(both @ self.weights[4])[:, :, 0], [both, runs[0][1], runs[1][1]]

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        p, (both, *kept) = self.forward(x, mask)
        error = ((p - label) * mask / mask.sum())[:, :, None]
        out = [np.zeros_like(w) for w in self.weights]
        out[4] = (both * error).sum(axis=(0, 1))[:, None]
        back = error * self.weights[4][:, 0]
        for way in (0, 1):
            again = self.weights[2 * way + 1]
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, h, c, i, f, o, g, tanh_c, m in reversed(kept[way]):
                dh = dh + back[t][:, way * HIDDEN : (way + 1) * HIDDEN]
                into = m * dh
                d_c = m * dc + into * o * (1 - tanh_c**2)
                gates = np.concatenate([d_c * g * i * (1 - i), d_c * c * f * (1 - f), into * tanh_c * o * (1 - o), d_c * i * (1 - g**2)], axis=1)
                out[2 * way] += x[t].T @ gates
                out[2 * way + 1] += h.T @ gates
                dh, dc = gates @ again.T + (1 - m) * dh, d_c * f + (1 - m) * dc
        return out


def _together(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x, mask = np.zeros((longest, len(pages), INPUTS), np.float32), np.zeros((longest, len(pages)), np.float32)
    for k, rows in enumerate(pages):
        x[: len(rows), k], mask[: len(rows), k] = rows, 1
    return x, mask


def labelled(rng: random.Random) -> tuple[list[Block], np.ndarray]:
    """Blocks of a made page; a mark at the beginning of the article's texts gives the labels and is taken out again."""
    html = "".join(_TEXT.sub(">\x01", piece) if inside else piece for piece, inside in made_pages.page(rng))
    found = blocks(html)
    inside = np.array(["\x01" in b.text for b in found], np.float32)
    return [Block(b.path, b.text.replace("\x01", "").strip() or ".", b.linked) for b in found], inside


@cache
def trained() -> Labeller:
    rng, numbers = random.Random(SEED), np.random.default_rng(SEED)
    model = Labeller(numbers)
    made = [labelled(rng) for _ in range(PAGES)]
    rows = [(vectors(found), label) for found, label in made if found]
    moment = [[np.zeros_like(w) for w in model.weights] for _ in range(2)]
    step = 0
    for epoch in range(EPOCHS):
        order = sorted(numbers.permutation(len(rows)).tolist(), key=lambda i: len(rows[i][0]) // 10)
        starts = numbers.permutation(range(0, len(order), TOGETHER))
        for low in starts:
            part = [rows[i] for i in order[low : low + TOGETHER]]
            x, mask = _together([r for r, _ in part])
            label = np.zeros_like(mask)
            for k, (_, y) in enumerate(part):
                label[: len(y), k] = y
            step += 1
            rate = RATE * (0.3 if epoch == EPOCHS - 1 else 1)
            for w, g, a, b in zip(model.weights, model.gradients(x, mask, label), *moment, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                w -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def extracted(model: Labeller, pages: list[str | None]) -> list[str]:
    """Main text of each page, blocks joined by a newline."""
    parsed = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i, b in enumerate(parsed) if b), key=lambda i: len(parsed[i]))
    low = 0
    while low < len(order):
        high = low + 1
        while high < len(order) and (high - low + 1) * len(parsed[order[high]]) <= BATCH_BLOCKS:
            high += 1
        group = order[low:high]
        x, mask = _together([vectors(parsed[i]) for i in group])
        keep = model.forward(x, mask)[0] >= 0.5
        for k, i in enumerate(group):
            out[i] = "\n".join(b.text for b, yes in zip(parsed[i], keep[:, k], strict=False) if yes)
        low = high
    return out


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    model = trained()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = extracted(model, part["html"].to_pylist())
                yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(read, "page_id long, url string, text string, n_chars long")
