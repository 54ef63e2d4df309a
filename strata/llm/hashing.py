"""Vectorised hashing of words and token windows (numpy, used inside tasks)."""

from __future__ import annotations

import numpy as np

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> U(30)
        x *= U(0xBF58476D1CE4E5B9)
        x ^= x >> U(27)
        x *= U(0x94D049BB133111EB)
        x ^= x >> U(31)
    return x


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit values that depend only on position and ``seed``."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + U(seed * 1_000_003)) * U(0x9E3779B97F4A7C15))


_BYTE = stream(256, 7)
_POS = stream(4096, 11)


def _positions(n: int) -> np.ndarray:
    global _POS
    if n > len(_POS):
        _POS = stream(max(n, 2 * len(_POS)), 11)
    return _POS


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes as an array, and the [start, end) offsets of the words between ASCII white space."""
    a = np.frombuffer(data, np.uint8)
    gap = np.ones(len(a) + 2, np.int8)
    gap[1:-1] = (a == 32) | ((a >= 9) & (a <= 13))
    d = np.diff(gap)
    return a, np.flatnonzero(d == -1), np.flatnonzero(d == 1)


def word_hashes(data: bytes, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word (``lower``: A-Z count as a-z)."""
    a, s, e = word_bounds(data)
    if not len(s):
        return np.empty(0, np.uint64)
    if lower:
        a = np.where((a >= 65) & (a <= 90), a + 32, a)
    size = e - s
    ends = np.cumsum(size)
    at = np.arange(ends[-1]) - np.repeat(ends - size, size)  # place within its word
    with np.errstate(over="ignore"):
        v = _BYTE[a[np.repeat(s, size) + at]] * (_positions(int(size.max()))[at] | U(1))
        return mix(np.add.reduceat(v, ends - size) + size.astype(np.uint64) * U(0xD6E8FEB86659FD93))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` consecutive tokens from each place on."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    mul = stream(n, 23) | U(1)
    m = len(h) - n + 1
    with np.errstate(over="ignore"):
        out = h[:m] * mul[0]
        for i in range(1, n):
            out = out + h[i : i + m] * mul[i]
    return mix(out)


BASE = 0x9DDFEA08EB382D69


class Rolling:
    """Hashes of any token range by prefix sums of a polynomial modulo 2**64."""

    _pow = np.ones(1, np.uint64)
    _inv = np.ones(1, np.uint64)

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._pow) < n:
            m = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                for name, b in (("_pow", BASE), ("_inv", pow(BASE, -1, 1 << 64))):
                    x = np.full(m, b, np.uint64)
                    x[0] = 1
                    setattr(cls, name, np.multiply.accumulate(x))
        return cls._pow, cls._inv

    def __init__(self, tokens: np.ndarray):
        p, self.inv = self.powers(len(tokens) + 1)
        self.sums = np.zeros(len(tokens) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(tokens * p[: len(tokens)], out=self.sums[1:])

    def of(self, at: np.ndarray, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[at + n] - self.sums[at]) * self.inv[at])

    def all(self, n: int) -> np.ndarray:
        m = len(self.sums) - n
        with np.errstate(over="ignore"):
            return mix((self.sums[n:] - self.sums[:m]) * self.inv[:m])


BYTE_TOKENS = stream(256, 31)
