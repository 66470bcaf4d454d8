"""Hashed character n-grams of whole texts. Small helpers of the classifiers' tasks."""

from __future__ import annotations

from functools import cache

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xD1B54A32D192ED03)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@cache
def shapes() -> np.ndarray:
    """Code points by kind: small letter, capital, digit, white space but the line end; others stand."""
    out = np.arange(0x110000, dtype=np.uint32)
    out[letters()] = ord("a")
    out[[c for c in range(0x3000) if chr(c).isupper()]] = ord("A")
    out[[c for c in range(0x3000) if chr(c).isdigit()]] = ord("0")
    out[[c for c in range(0x3000) if chr(c).isspace() and c != 10]] = ord(" ")
    return out


def hashed(points: np.ndarray, order: int, bits: int, salt: int = 0) -> np.ndarray:
    """The hash of every n-gram of one order, ``bits`` wide; none in shorter texts."""
    n = len(points) - order + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    total = np.full(n, order + 16 * salt, dtype=np.uint64)
    for i in range(order):
        total = (total + points[i : n + i]) * _STEP
        total ^= total >> np.uint64(29)
    return ((total * _LAST) >> np.uint64(64 - bits)).astype(np.int64)
