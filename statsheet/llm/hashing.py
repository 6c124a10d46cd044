"""Hashes of byte ranges in numpy, without a Python loop over bytes.

``prefix`` sums ``(byte + 1) * B**i`` modulo the prime 2**61 - 1, so the hash of any
range is a difference of two sums times the inverse power of its start.  Two
different strings of n bytes collide for at most n of the 2**61 - 2 bases, so for a
base drawn at random with a probability of at most n / 2**61, whatever the strings are
(sums modulo 2**64, by contrast, collide for some strings at every base).  Jobs
draw their base on the driver (``draw``).  ``mix`` spreads a value over 64 bits.
"""

from __future__ import annotations

import secrets
from functools import lru_cache

import numpy as np

PRIME = (1 << 61) - 1
#: Longest array of bytes that ``prefix`` takes: the sums of high and low halves stay below 2**63.
LONGEST = 1 << 22

_P = np.uint64(PRIME)


def _u(x: int) -> np.uint64:
    return np.uint64(x)


def reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime."""
    x = (x & _P) + (x >> _u(61))
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a * b`` modulo the prime, of reduced values, by halves of 31 and 30 bits."""
    a_high, a_low = a >> _u(31), a & _u((1 << 31) - 1)
    b_high, b_low = b >> _u(31), b & _u((1 << 31) - 1)
    middle = a_high * b_low + a_low * b_high  # below 2**62
    # 2**62 is 2, and 2**31 * 2**30 is 1.
    return reduced(_u(2) * a_high * b_high + (middle >> _u(30)) + ((middle & _u((1 << 30) - 1)) << _u(31)) + a_low * b_low)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (a common finalizer)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def draw() -> int:
    """A base for one job."""
    return 2 + secrets.randbelow(PRIME - 3)


class Hasher:
    """Hashes for one base; keeps its powers up to the longest array asked for."""

    def __init__(self, base: int):
        self.base, self.inverse_base = base, pow(base, -1, PRIME)
        self.powers = self.inverses = np.ones(1, np.uint64)
        self.low = self.high = self.powers

    def _grow(self, n: int) -> None:
        if n > LONGEST:
            raise ValueError(f"at most {LONGEST} bytes at a time")
        while len(self.powers) < n:
            have = len(self.powers)
            self.powers, self.inverses = (
                np.concatenate((x, times(x, np.full(have, pow(b, have, PRIME), np.uint64)))) for x, b in ((self.powers, self.base), (self.inverses, self.inverse_base))
            )
            self.low, self.high = self.powers & _u((1 << 32) - 1), self.powers >> _u(32)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """``len(data) + 1`` running sums over an array of bytes."""
        n = len(data)
        self._grow(n + 1)
        value = data.astype(np.uint64) + _u(1)
        low, high = np.cumsum(value * self.low[:n]), np.cumsum(value * self.high[:n])  # below 2**63, 2**60
        out = np.zeros(n + 1, np.uint64)
        # high * 2**32: 2**29 of these are 1.
        out[1:] = reduced((high >> _u(29)) + ((high & _u((1 << 29) - 1)) << _u(32)) + reduced(low))
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the byte ranges [start, end); equal bytes give equal hashes."""
        return mix(times(reduced(sums[end] + _P - sums[start]), self.inverses[start]))

    def windows(self, sums: np.ndarray, size: int) -> np.ndarray:
        """Hashes of all ranges of ``size`` bytes, by start."""
        n = len(sums) - size
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix(times(reduced(sums[size:] + _P - sums[:n]), self.inverses[:n]))


class Wrapping:
    """Cheaper sums modulo 2**64, for choices that equal bytes must make alike but where
    a collision does no harm, or beside a ``Hasher``: some built strings collide at any base."""

    def __init__(self, base: int):
        self.base = base | 1
        self.inverse_base = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)
        self.table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(self.base))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        while len(self.powers) <= n:
            have = len(self.powers)
            self.powers, self.inverses = (np.concatenate((x, x * np.uint64(pow(b, have, 1 << 64)))) for x, b in ((self.powers, self.base), (self.inverses, self.inverse_base)))
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[:n], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.inverses[start])

    def windows(self, sums: np.ndarray, size: int) -> np.ndarray:
        n = len(sums) - size
        return mix((sums[size:] - sums[:n]) * self.inverses[:n]) if n > 0 else np.empty(0, np.uint64)


@lru_cache(maxsize=8)
def wrapping(base: int) -> Wrapping:
    return Wrapping(base)


@lru_cache(maxsize=8)
def hasher(base: int) -> Hasher:
    """One hasher for each base and Python worker."""
    return Hasher(base)


#: For uses outside a job, such as tests.
FIXED_BASE = 0x1B873593CC9E2D51
