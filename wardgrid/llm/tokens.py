"""Token ids of whole texts with a public tokenizer file, one encoding per distinct piece.

The file lower-cases, cuts texts into letters, single digits, other signs and a few endings after an apostrophe, and
codes each cut alone. So a text's ids are those of its pieces in order, where a piece ends at ASCII white space and
where the bytes on both sides, being ASCII, show that a cut ends. Words with the beginning of a special token stay
whole and as they are. Each slice of a batch encodes its distinct pieces once; pieces met before are kept in arrays
of bounded size per Python worker.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

from . import seqhash

#: Pieces a worker remembers, with eight ids each on average; then it starts anew. This bounds memory and changes no result.
REMEMBERED = 600_000
#: Per tokenizer file: sorted word hashes, where the ids of each begin, how many they are, and all ids.
_KNOWN: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
_NONE = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _closing(path: str) -> np.ndarray:
    """By id, whether the token ends what it is a part of."""
    vocabulary = _tokenizer(path).get_vocab()
    closing = np.zeros(max(vocabulary.values()) + 1, bool)
    closing[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return closing


_SPACE, _LETTER, _DIGIT, _APOSTROPHE, _SIGN, _BEYOND = range(6)


def _kinds() -> np.ndarray:
    kind = np.full(256, _SIGN, np.uint8)
    kind[[32, *range(9, 14)]] = _SPACE
    kind[[*range(65, 91), *range(97, 123)]] = _LETTER
    kind[48:58] = _DIGIT
    kind[39] = _APOSTROPHE
    kind[128:] = _BEYOND
    return kind


def _cuts() -> np.ndarray:
    """Whether a piece ends between bytes of two kinds; an apostrophe may belong to the letters after it."""
    cut = np.zeros((6, 6), bool)
    cut[_DIGIT, :_BEYOND] = cut[:_BEYOND, _DIGIT] = True
    cut[_LETTER, [_APOSTROPHE, _SIGN]] = cut[_SIGN, _LETTER] = True
    cut[_SPACE, 1:] = cut[1:, _SPACE] = True
    return cut.ravel()


_KIND, _CUT = _kinds(), _cuts()


def pieces(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes in lower case, start and end of each piece, and how many pieces lie before each text."""
    kind, lower = _KIND[data], seqhash.lower_ascii(data)
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = _CUT[kind[:-1] * np.uint8(6) + kind[1:]]
    special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    if len(special):
        starts, ends, _ = seqhash.word_bounds(data, at)
        word = np.unique(np.searchsorted(starts, special, "right") - 1)
        depth = np.zeros(len(data) + 1, np.int8)
        depth[starts[word]] += 1
        depth[ends[word]] -= 1
        whole = np.cumsum(depth[:-1], dtype=np.int8) > 0
        edge[1:-1] &= ~(whole[1:] & whole[:-1])
        lower = np.where(whole, data, lower)
    edge[at] = True
    cuts = np.flatnonzero(edge)
    full = kind[cuts[:-1]] != _SPACE if len(data) else np.zeros(len(cuts) - 1, bool)
    starts = cuts[:-1][full]
    return lower, starts, cuts[1:][full], np.searchsorted(starts, at)


def _joins(text: str) -> bool:
    """Most likely a single part for the tokenizer."""
    return (text.isascii() or text.isalpha()) and "'" not in text and "<|" not in text


def _coded(path: str, texts: list[str], joined: bool) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each text has, and the ids; joined texts are told apart by the tokens that end a part."""
    if joined:
        ids = np.array(_tokenizer(path).encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(_closing(path)[ids])
        if len(last) == len(texts):  # each has at least one part, so each has just one
            return np.diff(last, prepend=-1), ids
    each = [e.ids for e in _tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]
    return np.array([len(e) for e in each], np.int64), np.fromiter((i for e in each for i in e), np.uint32)


def _piece_ids(path: str, known: np.ndarray, first: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each distinct piece (by ascending hash) where its ids begin and how many they are; and the ids."""
    hashes, begins, sizes, flat = _KNOWN.get(path, _NONE)
    if len(hashes) > REMEMBERED or len(flat) > 8 * REMEMBERED:
        hashes, begins, sizes, flat = _NONE
    place = np.searchsorted(hashes, known)
    new = np.flatnonzero(~np.isin(known, hashes, assume_unique=True))
    if len(new):
        low, high = starts[first[new]].tolist(), ends[first[new]].tolist()
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(low, high, strict=True)]
        joins = np.fromiter(map(_joins, texts), bool, len(texts))
        begin, size, coded, past = np.empty(len(new), np.int64), np.empty(len(new), np.int64), [flat], len(flat)
        for joined in (True, False):
            which = np.flatnonzero(joins == joined)
            for part in np.split(which, range(2_000, len(which), 2_000)) if len(which) else ():
                counts, ids = _coded(path, [texts[i] for i in part], joined)
                size[part], begin[part] = counts, past + np.cumsum(counts) - counts
                coded.append(ids)
                past += len(ids)
        begins, sizes = np.insert(begins, place[new], begin), np.insert(sizes, place[new], size)
        hashes, flat = np.insert(hashes, place[new], known[new]), np.concatenate(coded)
        _KNOWN[path] = hashes, begins, sizes, flat
        place = np.searchsorted(hashes, known)
    return begins[place], sizes[place], flat


def encoded(column: pa.Array, path: str, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids, offsets) of runs of texts; ``end_id`` closes each text. Null is empty."""
    for row, data, at in seqhash.slices(column, 4 * seqhash.SLICE):
        data, starts, ends, before = pieces(data, at)
        words, first, inverse = np.unique(seqhash.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        begins, sizes, flat = _piece_ids(path, words, first, data, starts, ends)
        # closing ids are pieces of their own, each after the last piece of its text
        flat = np.append(flat, np.uint32(end_id))
        word = np.insert(inverse, before[1:], len(words))
        sizes, begins = np.append(sizes, 1), np.append(begins, len(flat) - 1)
        length = sizes[word]
        past = np.cumsum(length)
        ids = flat[np.repeat(begins[word] - past + length, length) + np.arange(past[-1] if len(past) else 0)]
        texts = len(at) - 1
        closing = before[1:] + np.arange(texts)
        yield row, ids, np.append(0, past[closing])
