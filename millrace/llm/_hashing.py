"""Vectorised 64-bit hashes of the words and word shingles of many texts at once."""

from __future__ import annotations

import functools

import numpy as np

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit changes every output bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, _U), np.full(n, _BASE_INVERSE, _U)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(1 << 21, 1 << int(n).bit_length()))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of bytes other than ASCII white space) of all texts in data.

    Returns hash, first byte and end byte of each word, and the index of each text's first word with the total last.
    """
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~_SPACE[data]
    begins = inside[:n].copy()
    begins[1:] &= ~inside[: n - 1]
    cut = offsets[:-1]
    cut = cut[cut < n]
    begins[cut] = inside[cut]  # a text starts a new word
    ends = inside[1:] ^ True
    ends[offsets[1:][offsets[1:] > 0] - 1] = True
    first = np.flatnonzero(begins)
    last = np.flatnonzero(ends & inside[:n]) + 1
    up, down = _powers_for(n)
    total = np.zeros(n + 1, _U)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    return mix((total[last] - total[first]) * down[first]), first, last, np.searchsorted(first, offsets)


def shingles(word: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within a text, and the text of each; a text of 1 to k-1 words has one run of all its words."""
    count = np.diff(bounds)
    runs = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(count)), runs)
    start = np.repeat(bounds[:-1], runs) + np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs)
    size = np.minimum(count[doc], k)
    padded = np.concatenate([word, np.zeros(k, _U)])
    out = np.zeros(len(doc), _U)
    for i in range(k):
        term = padded[start + i] * mix(np.array([i + 1], _U) * _BASE)[0]
        out += term if i == 0 else np.where(size > i, term, _U(0))
    return mix(out), doc
