"""Vectorised 64-bit hashes of words and word windows.

A word's hash is a polynomial in random values of its bytes (a prefix sum
over the text gives all words at once), then mixed; a window's hash is a
polynomial in its words' hashes, mixed again. Fixed seeds: the same on every
worker and in every run.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTE_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15                  # odd, so it has an inverse modulo 2**64
_UNBASE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)

#: The white space that ends words: space and U+0009 to U+000D.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to lower case, all other bytes unchanged.
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))

_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, _UNBASE)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _POWERS[i] = np.cumprod(row)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes, block: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start offset) of each word of ``data``, in order. Works through
    blocks that end in white space, so memory follows the block (or the
    longest word), not the text."""
    hashes, offsets, at = [], [], 0
    while at < len(data):
        stop = min(len(data), at + block)
        raw = np.frombuffer(data, np.uint8, stop - at, at)
        gap = SPACES[raw]
        if stop < len(data):
            cut = np.flatnonzero(gap)
            while not len(cut) and stop < len(data):        # a word longer than the block
                stop = min(len(data), at + 2 * (stop - at))
                raw = np.frombuffer(data, np.uint8, stop - at, at)
                gap = SPACES[raw]
                cut = np.flatnonzero(gap)
            if stop < len(data):
                raw, gap = raw[:cut[-1] + 1], gap[:cut[-1] + 1]
        gap = np.concatenate([[True], gap, [True]])
        edge = np.flatnonzero(gap[1:] != gap[:-1])          # words begin and end in turn
        begin, end = edge[::2], edge[1::2]
        up, down = _powers(len(raw) + 1)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[raw] * up[:-1], out=total[1:])
        hashes.append(mix((total[end] - total[begin]) * down[begin]))
        offsets.append(begin + at)
        at += len(raw)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(offsets)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words."""
    count = max(0, len(words) - n + 1)
    h = np.zeros(count, np.uint64)
    for j in range(n):
        h = h * _STEP + words[j:j + count]
    return mix(h)


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each run of ``n`` values, in log steps."""
    size = 1
    while size * 2 <= n:
        x = np.minimum(x[:-size], x[size:]) if len(x) > size else x[:0]
        size *= 2
    rest = n - size
    return (np.minimum(x[:-rest], x[rest:]) if len(x) > rest else x[:0]) if rest else x
