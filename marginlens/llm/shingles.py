"""Vectorised words and word shingles of a text.

Words are the contract's: ``A-Z`` lower-cased, runs of anything but the ASCII
characters outside ``[0-9a-z]``. A word's hash is a polynomial over its bytes,
taken from prefix sums over the whole text, so no Python object is made per
word. A shingle is ``width`` consecutive words; a text of fewer words, but not
none, is one shingle.
"""
from __future__ import annotations

import numpy as np

WIDTH = 5
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=_U)
_powers = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        size = max(n, 2 * len(have), 1 << 12)
        factors = np.full(size, _BASE if kind == "up" else _INVERSE, _U)
        factors[0] = 1
        have = _powers[kind] = np.multiply.accumulate(factors)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of every word, in order."""
    data = np.frombuffer((text or "").encode("utf-8", "replace").translate(_LOWER), np.uint8)
    return _words(data)[0]


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of lower-cased UTF-8 bytes."""
    if not len(data):
        return np.empty(0, _U), np.empty(0, np.int64)
    edge = np.diff(np.concatenate(([False], _IS_WORD[data], [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * _power("up", len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power("down", len(data))[starts] + (ends - starts).astype(_U)), starts


def shingles_of(texts: list[bytes | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of UTF-8 texts laid end to end, and how many each has; of a text of
    fewer than ``width`` words none."""
    texts = [t or b"" for t in texts]
    data = np.frombuffer(b"\n".join(texts).translate(_LOWER), np.uint8)
    words, starts = _words(data)
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    upto = np.searchsorted(starts, ends)
    per = np.diff(upto, prepend=0)
    count = np.maximum(per - width + 1, 0)
    if len(words) < width:
        return words[:0], count
    inside = np.arange(len(words) - width + 1) + width <= np.repeat(upto, per)[:len(words) - width + 1]
    return shingle_hashes(words, width)[inside], count


def shingle_hashes(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """64-bit hash of every shingle, by its first word."""
    n = len(words)
    if not n:
        return words
    width = min(width, n)
    out = np.full(n - width + 1, width, _U)
    for k in range(width):
        out = out * _U(_BASE) + words[k:n - width + 1 + k]
    return mix(out)
