"""Vectorised word and window hashing of whole texts (NumPy, inside tasks).

A word is a run of characters outside ``[\\x20\\x09-\\x0D]``.  All hashes are
64 bits: a word is a polynomial over its bytes (each byte mapped to a random
odd value) passed through a finaliser; a window is a polynomial over its word
hashes, again finalised.  Prefix sums make the cost per byte constant, with no
table of words to keep."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE, _WINDOW = 0x9E3779B97F4A7C15 | 1, 0xD1B54A32D192ED03 | 1
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0..n-1 modulo 2^64 (kept and grown by doubling)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        out = np.ones(size, dtype=np.uint64)
        with np.errstate(over="ignore"):
            out[1:] = _U(base)
            np.multiply.accumulate(out, out=out)
        _powers[base] = have = out
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte offsets of the words of a UTF-8 byte array."""
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~SPACE[raw]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word."""
    raw = np.frombuffer(text, dtype=np.uint8)
    start, end = word_spans(raw)
    if not len(start):
        return np.empty(0, np.uint64), start, end
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[raw] * powers(_BASE, len(raw)), out=sums[1:])
        value = (sums[end] - sums[start]) * powers(inverse(_BASE), len(raw))[start]
        return mix(value + (end - start).astype(np.uint64)), start, end


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (none if fewer)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * powers(_WINDOW, len(words)), out=sums[1:])
        return mix((sums[size:] - sums[:n]) * powers(inverse(_WINDOW), n) + _U(size))


def shingle_set(text: str | None, size: int, lower: bool = True) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of a text; with
    fewer words the whole sequence is one shingle; none without words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = word_hashes(raw.translate(LOWER) if lower else raw)[0]
    return np.unique(window_hashes(words, min(size, len(words)))) if len(words) else words


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Mask of the ``n`` words that windows of ``size`` at ``starts`` cover."""
    step = np.zeros(n + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + size, -1)
    return np.cumsum(step[:-1]) > 0
