"""Sets of hashed word shingles, in whole-array steps over a text's bytes."""

from __future__ import annotations

import numpy as np

_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(b" \t\n\x0b\x0c\r")] = True
# a random number for each byte; ASCII letters of either case have one
_LETTER = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(2 * n, 1 << 16), base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_edges(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of a UTF-8 text starts and ends (exclusive), in bytes."""
    inside = ~_BLANK[np.frombuffer(data, dtype=np.uint8)]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edge[::2], edge[1::2]


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text, ASCII case folded, in order: differences of prefix sums."""
    b = np.frombuffer(data, dtype=np.uint8)
    start, end = word_edges(data)
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    up, down = _power(len(b) + 1)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_LETTER[b] * up[: len(b)], dtype=np.uint64)])
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_set(data: bytes, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words; a shorter text with words is one shingle."""
    h = word_hashes(data)
    n = len(h) - words + 1
    if n < 1:
        short = np.array([len(h)], dtype=np.uint64)
        for x in h:
            short = mixed(short * _BASE + x)
        return short if len(h) else h
    out = h[:n].copy()
    for k in range(1, words):
        out *= _BASE
        out += h[k : n + k]
    return np.unique(mixed(out))
