"""Two-stage suffix sorting of one bounded piece of bytes, as numpy array operations.

A suffix is of kind B if it is smaller than its successor, else of kind A. Only the B suffixes are
sorted directly. The A suffixes follow from one scan over the buckets of first bytes in ascending
order: whoever precedes the suffixes of a finished bucket falls, in that order, to the next free
place of its own bucket. The order is exact in the first ``depth`` bytes.
"""

from __future__ import annotations

import numpy as np

from . import seqhash

_STEP = 8


def packed(data: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes from each position on as one number; beyond the end stand 255s."""
    padded = np.full(len(data) + depth + 2 * _STEP, 255, np.uint8)
    padded[: len(data)] = data
    words = np.zeros(len(padded) - _STEP, np.uint64)
    for j in range(_STEP):
        words = (words << np.uint64(8)) | padded[j : len(words) + j]
    return words


def smaller_than_successor(data: np.ndarray) -> np.ndarray:
    """Kind B of each suffix; equal neighbours take the kind of the next, the last one is of kind A."""
    n = len(data)
    change = np.flatnonzero(data[1:] != data[:-1])
    at = np.searchsorted(change, np.arange(n))
    smaller = np.zeros(n, bool)
    known = at < len(change)
    spot = change[at[known]]
    smaller[known] = data[spot] < data[spot + 1]
    return smaller


def _sorted_directly(words: np.ndarray, whole: np.ndarray, chosen: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``chosen`` in the order of their first ``depth`` bytes.

    Ties are refined eight bytes at a time, unless all of them agree over the whole depth (``whole``).
    """
    order = chosen[np.argsort(words[chosen], kind="stable")]
    first = words[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = first[1:] == first[:-1]
    for step in range(_STEP, depth, _STEP):
        tied = np.flatnonzero(same[:-1] | same[1:])
        if not len(tied):
            break
        starts = np.flatnonzero(~same[tied])
        group = np.cumsum(~same[tied]) - 1
        whole_of = whole[order[tied]]
        equal = np.minimum.reduceat(whole_of, starts) == np.maximum.reduceat(whole_of, starts)
        done = equal[group]
        same[tied[done]] = False
        tied, group = tied[~done], group[~done]
        if not len(tied):
            break
        key = words[order[tied] + step]
        again = np.lexsort((key, group))
        order[tied] = order[tied][again]
        key = key[again]
        kept = np.zeros(len(tied), bool)
        kept[1:] = (group[1:] == group[:-1]) & (key[1:] == key[:-1])
        same[tied] = kept
    return order


def suffix_order(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All positions in the order of the suffixes' first ``depth`` bytes, and ``packed`` of the data."""
    n = len(data)
    words = packed(data, depth)
    whole = seqhash.Rolling(seqhash.byte_values(np.append(data, np.full(depth, 255, np.uint8)))).every(depth)
    direct = _sorted_directly(words, whole, np.flatnonzero(smaller_than_successor(data)), depth)
    sizes = np.bincount(data, minlength=256)
    b_ends = np.cumsum(np.bincount(data[direct], minlength=256))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n:
        waiting[data[-1]].append(np.array([n - 1]))
    buckets = []
    for byte in np.flatnonzero(sizes):
        induced = waiting[byte]
        fresh = np.concatenate(induced) if induced else np.empty(0, np.int64)
        run = [fresh]
        while len(fresh):  # a run of equal bytes: each follows from its successor in the same bucket
            fresh = fresh[fresh > 0] - 1
            fresh = fresh[data[fresh] == byte]
            run.append(fresh)
        bucket = np.concatenate([*run, direct[(b_ends[byte - 1] if byte else 0) : b_ends[byte]]])
        buckets.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[data[before] > byte]
        before = before[np.argsort(data[before], kind="stable")]
        cuts = np.flatnonzero(np.diff(data[before])) + 1
        for part in np.split(before, cuts) if len(before) else []:
            waiting[data[part[0]]].append(part)
    return (np.concatenate(buckets) if buckets else np.empty(0, np.int64)), words


def adjacent_prefixes(words: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether each position of ``order`` agrees with the one before it in ``depth`` bytes."""
    agree = np.zeros(len(order), bool)
    still = np.arange(1, len(order))
    for step in range(0, depth, _STEP):
        left, right = words[order[still - 1] + step], words[order[still] + step]
        spare = max(0, step + _STEP - depth)
        still = still[(left >> np.uint64(8 * spare)) == (right >> np.uint64(8 * spare))]
    agree[still] = True
    return agree
