"""Words and word shingles of many texts at once, as 64-bit hashes (numpy over UTF-8 bytes)."""

from __future__ import annotations

import numpy as np

# Word separators: space, and the control characters 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A"):ord("Z") + 1] += 32
_LOWER += np.uint64(1)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_power = np.cumprod(np.full(64, _BASE, np.uint64))


def _powers(n: int) -> np.ndarray:
    global _power
    if n > 1 << 16:  # a rare giant word: not kept
        return np.cumprod(np.full(n, _BASE, np.uint64))
    if n > len(_power):
        _power = np.cumprod(np.full(n, _BASE, np.uint64))
    return _power


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and shift)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(buf: np.ndarray, off: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first byte) of every word, A-Z lower-cased, in order; ``off`` starts at 0.

    breaks: of each byte, whether it parts words."""
    n = len(buf)
    space = breaks[buf]
    value = np.where(breaks, np.uint64(0), _LOWER)
    first = np.empty(n, bool)
    if n:
        first[0] = True
        first[1:] = space[:-1]
        first[off[:-1][off[:-1] < n]] = True  # a row's first byte never continues a word
    starts = np.flatnonzero(first & ~space)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), starts
    low = starts[0]
    length = np.diff(np.append(starts, n))
    pos = np.arange(low, n) - np.repeat(starts, length)
    h = np.add.reduceat(value[buf[low:]] * _powers(int(length.max()))[pos], starts - low)
    return mix(h), np.searchsorted(off, starts, side="right") - 1, starts


def shingles(h: np.ndarray, row: np.ndarray, k: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each row, and the bounds (rows + 1) of the rows.

    A row with 1 to k - 1 words has its whole sequence as one shingle; one without words has none."""
    first = np.searchsorted(row, np.arange(rows + 1))
    out, bounds = [], np.zeros(rows + 1, np.int64)
    if len(h) >= k:
        s = np.zeros(len(h) - k + 1, np.uint64)
        for j in range(k):
            s = s * np.uint64(0xD6E8FEB86659FD93) + h[j:len(h) - k + 1 + j]
        s = mix(s)
    for i in range(rows):
        a, b = first[i], first[i + 1]
        if b - a >= k:
            u = np.unique(s[a:b - k + 1])
        elif b > a:
            t = np.uint64(b - a)
            for x in h[a:b]:
                t = np.uint64((int(t) * 0xA0761D6478BD642F + int(x)) & 0xFFFFFFFFFFFFFFFF)
            u = mix(np.array([t], np.uint64))
        else:
            u = np.zeros(0, np.uint64)
        out.append(u)
        bounds[i + 1] = bounds[i] + len(u)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), bounds
