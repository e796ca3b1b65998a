"""Words and shingles of a text, hashed without a Python loop over characters.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z: exactly what
``bytes.lower().split()`` does on UTF-8.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240501).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_pow = {_BASE: np.ones(1, _U), _INV: np.ones(1, _U)}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64, kept and doubled as needed."""
    have = _pow[base]
    while len(have) < n:
        have = np.concatenate([have, have * _U(pow(base, len(have), 1 << 64))])
    _pow[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), so that any bits of a hash can be used."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def window_hashes(words: list[bytes], size: int) -> np.ndarray:
    """64-bit hash of each window of ``size`` words, in order; of the whole
    sequence when it is shorter; nothing without words."""
    if not words:
        return np.empty(0, _U)
    buf = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    at = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=at[1:])
    prefix = np.zeros(len(buf) + 1, _U)
    np.cumsum(_BYTE[buf] * _powers(_BASE, len(buf)), out=prefix[1:])
    size = min(size, len(words))
    start, end = at[: len(words) - size + 1], at[size:]
    return mix((prefix[end] - prefix[start]) * _powers(_INV, len(buf))[start])


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a whole text."""
    return np.unique(window_hashes(words_of(text), SHINGLE))
