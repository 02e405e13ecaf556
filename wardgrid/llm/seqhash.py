"""Hashes of many words and windows at once, as numpy arrays over whole batches.

Everything here is plain arithmetic modulo 2**64 on arrays of one slice of a batch;
memory is bounded by ``SLICE`` elements whatever the length of a text. What a worker keeps
between slices is one pair of tables of at most ``KEPT`` powers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Elements handled at once; positions inside a slice fit into POSITION_BITS.
SLICE = 1 << 19
POSITION_BITS = 20
#: Bytes of words that are hashed at once.
WORDS_SLICE = SLICE >> 2
#: Powers that a worker keeps; longer tables last as long as what needs them.
KEPT = 2 * SLICE

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_POSITION = _U((1 << POSITION_BITS) - 1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


@cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=_U) * _U(_BASE))


_NO_POWERS = (np.empty(0, _U), np.empty(0, _U))
_POWERS = _NO_POWERS


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse; shorter tables are the beginning of the one that is kept."""
    global _POWERS
    found = _POWERS
    if len(found[0]) < n:
        room = 1 << max(12, (n - 1).bit_length())
        up, down = np.empty(room, _U), np.empty(room, _U)
        up[0] = down[0] = 1
        up[1:], down[1:] = _U(_BASE), _U(pow(_BASE, -1, 1 << 64))
        found = np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)
        if room <= KEPT:
            _POWERS = found
    return found


class Rolling:
    """Hashes of any stretch of one slice of elements."""

    def __init__(self, values: np.ndarray):
        self.up, down = _powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, _U)
        np.cumsum(values * down[: len(values)], dtype=_U, out=self.sums[1:])

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.up[start]
        return mix(raw ^ ((end - start).astype(_U) * _U(0x2545F4914F6CDD1D)))

    def every(self, length: int) -> np.ndarray:
        """Of the stretch of ``length`` elements at each start."""
        n = len(self.sums) - length
        if n <= 0:
            return np.empty(0, _U)
        raw = (self.sums[length:] - self.sums[:n]) * self.up[:n]
        return mix(raw ^ _U(length * 0x2545F4914F6CDD1D & (1 << 64) - 1))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _byte_values()[data]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins (one more entry than texts); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type in (pa.string(), pa.large_string()):
        column = column.fill_null("") if column.null_count else column
    else:
        column = column.fill_null(b"") if column.null_count else column
    wide = column.type in (pa.large_string(), pa.large_binary())
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts of about ``most`` bytes; a longer text comes alone."""
    data, at = utf8(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        last = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        yield row, data[at[row] : at[last]], at[row : last + 1] - at[row]
        row = last


def is_space(data: np.ndarray) -> np.ndarray:
    """Space and the bytes 9 to 13."""
    return (data == 32) | ((data - np.uint8(9)) < 5)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + ((data - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and how many words lie before each text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~is_space(data)
    step = inside[1:] != inside[:-1]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    starts = np.flatnonzero(inside[1:] & (step | cut))
    ends = np.flatnonzero(inside[:-1] & (step | cut))
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word; words of a long text are taken some at a time."""
    out = np.empty(len(starts), _U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + WORDS_SLICE, "right")))
        low = starts[i]
        out[i:j] = Rolling(byte_values(data[low : ends[j - 1]])).stretch(starts[i:j] - low, ends[i:j] - low)
        i = j
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row."""
    span, low = 1, values
    while span * 2 <= width:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def chosen(values: np.ndarray, at: np.ndarray, window: int, part: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Windows by the part they choose.

    ``values`` are the elements of several texts, ``at`` where each begins. Each window of
    ``window`` elements inside one text chooses, of the parts of ``part`` elements in it, the one
    with the least hash: equal windows choose equal parts, wherever they stand. Yields arrays
    (text, first start, last start, hash of the part, hash of all elements of these windows) for
    runs of neighbouring windows with one choice. Starts count from the text's beginning.
    """
    total, width = len(values), window - part + 1
    for low in range(0, max(0, total - window + 1), SLICE):
        high = min(total, low + SLICE + window - 1)
        n = high - low - window + 1
        rolling = Rolling(values[low:high])
        hashes = rolling.every(part)
        marked = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=_U)
        pick = (sliding_min(marked, width)[:n] & _POSITION).astype(np.int64)
        starts = np.arange(low, low + n)
        text = np.searchsorted(at, starts, "right") - 1
        inside = starts + window <= at[text + 1]
        new = np.ones(n, bool)
        new[1:] = (pick[1:] != pick[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], n) - 1
        keep = inside[first]
        first, last = first[keep], last[keep]
        of = text[first]
        yield (of, first + low - at[of], last + low - at[of], hashes[pick[first]], rolling.stretch(first, last + window))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
