"""Words of many texts at once: their places in the bytes and 64-bit hashes.

Words are maximal runs of bytes outside a separator class, found with a lookup table.  All bytes
of characters beyond ASCII count as word bytes, so places never cut a character.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Blanks ``[\\x20\\x09-\\x0D]`` separate words.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15
_STEP = 0xD1342543DE82EF95
#: Bytes hashed at a time.
_CHUNK = 1 << 19


@dataclass
class Words:
    """Words of a block of texts; word ``i`` of row ``d`` is at ``first[d] + i``."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


_known_powers: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for at least ``size`` exponents."""
    if len(_known_powers.get(base, ())) < size:
        steps = np.full(1 << max(16, int(size - 1).bit_length()), base, np.uint64)
        steps[0] = 1
        _known_powers[base] = np.multiply.accumulate(steps)
    return _known_powers[base]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _range_hashes(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of ``values[lo:hi]`` for each pair, alike for alike contents."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values))[: len(values)], out=total[1:])
    return (total[hi] - total[lo]) * powers(pow(base, -1, 1 << 64), len(values) + 1)[lo]


def words_of(
    raw: np.ndarray, offsets: np.ndarray, blanks: np.ndarray = BLANKS, lower: bool = False
) -> Words:
    """Words of the rows ``raw[offsets[d]:offsets[d + 1]]``."""
    raw = raw[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~blanks[raw]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    hashes = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):  # a chunk of bytes at a time, cut between words
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + _CHUNK, side="right")))
        part = raw[start[lo] : end[hi - 1]]
        values = (LOWER[part] if lower else part).astype(np.uint64) + np.uint64(1)
        at = start[lo]
        hashes[lo:hi] = _range_hashes(values, start[lo:hi] - at, end[lo:hi] - at, _BASE)
        lo = hi
    return Words(start, end, first, mix(hashes))


def window_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of ``hashes[i:i + size]`` for each ``i``, across rows too (see ``inside``)."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    values = mix(hashes + np.uint64(seed)) if seed else hashes
    if size == 1:
        return mix(values)
    lo = np.arange(len(values) - size + 1)
    return mix(_range_hashes(values, lo, lo + size, _STEP))


def inside(first: np.ndarray, size: int) -> np.ndarray:
    """Starts of all windows of ``size`` words that lie in one row."""
    n = int(first[-1])
    if n < size:
        return np.zeros(0, np.int64)
    room = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return np.flatnonzero(room >= size)
