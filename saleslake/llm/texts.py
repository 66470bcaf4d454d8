"""Words and shingles of whole texts, as numpy hashes. Small helpers of the operators' tasks."""

from __future__ import annotations

import numpy as np

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MULTIPLIER = 0x9E3779B97F4A7C15
_POWERS = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads close ones."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    global _POWERS
    while len(_POWERS) < n:
        step = np.uint64(pow(_MULTIPLIER, len(_POWERS), 1 << 64))
        _POWERS = np.concatenate([_POWERS, _POWERS * step])
    return _POWERS[:n]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word (run of bytes that are not ASCII white space), A-Z lowered."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.concatenate([[False], ~SPACES[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    # A polynomial in the bytes, highest power first: sum of byte * m**(end - 1 - place).
    longest = int((ends - starts).max())
    word_of = np.repeat(np.arange(len(starts)), ends - starts)
    places = np.flatnonzero(inside[1:-1])
    power = _powers(longest)[ends[word_of] - 1 - places]
    values = (LOWER[raw[places]].astype(np.uint64) + np.uint64(1)) * power
    begins = np.concatenate([[0], np.cumsum(ends - starts)[:-1]])
    return mix(np.add.reduceat(values, begins) + (ends - starts).astype(np.uint64))
