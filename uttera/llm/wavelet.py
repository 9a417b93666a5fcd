"""Wavelet matrix in numpy: bit planes with rank and select, batch queries.

Level l holds bit ``bits-1-l`` of every symbol, in the order left by stable partitions on the
higher bits. Planes are packed to bytes; a rank query takes the ones before its 64-bit word from a
directory and the rest by a popcount up to the position; a select query searches the directory.
"""

from __future__ import annotations

import numpy as np

SELECT = 1 << 16  # positions looked up at a time


def bit_at(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th (from 0) one in each 64-bit word."""
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return (np.cumsum(bits, axis=1) > k[:, None]).argmax(1)


class Queries:
    """Batch queries over levels that answer ``_rank1``, ``_bit`` and ``_select``; ``n``, ``bits`` and ``zeros`` are set."""

    n: int
    bits: int
    zeros: list[int]

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        lo, hi = np.zeros(len(i), np.int64), np.asarray(i, np.int64)
        for level in range(self.bits):
            one = (symbols >> (self.bits - 1 - level)) & 1 != 0
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            lo, hi = np.where(one, self.zeros[level] + a, lo - a), np.where(one, self.zeros[level] + b, hi - b)
        return hi - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        """Symbols at positions."""
        i, out = np.asarray(i, np.int64), np.zeros(len(i), np.int64)
        for level in range(self.bits):
            a, one = self._rank1(level, i), self._bit(level, i)
            out = out << 1 | one
            i = np.where(one, self.zeros[level] + a, i - a)
        return out

    def count(self, symbol: int) -> int:
        """Occurrences of a symbol; one that needs more bits has none."""
        return 0 if symbol < 0 or symbol >> self.bits else int(self.rank(np.array([symbol]), np.array([self.n]))[0])

    def select(self, symbol: int, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th (from 0) occurrences of a symbol."""
        lo, ones = 0, []
        for level in range(self.bits):
            a = int(self._rank1(level, np.array([lo]))[0])
            ones.append(symbol >> (self.bits - 1 - level) & 1)
            lo = self.zeros[level] + a if ones[-1] else lo - a
        pos = lo + np.asarray(k, np.int64)
        for level in reversed(range(self.bits)):
            at = pos - self.zeros[level] if ones[level] else pos
            parts = [self._select(level, at[x : x + SELECT], bool(ones[level])) for x in range(0, len(at), SELECT)]
            pos = np.concatenate(parts) if parts else at
        return pos

    def positions(self, symbol: int) -> np.ndarray:
        """Every position of a symbol, ascending."""
        return self.select(symbol, np.arange(self.count(symbol)))


class WaveletMatrix(Queries):
    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.bits = len(symbols), bits
        self.planes: list[np.ndarray] = []
        a = symbols.astype(np.uint16 if bits <= 16 else np.uint32)
        out = np.empty_like(a)
        for level in range(bits):
            b = (a & a.dtype.type(1 << (bits - 1 - level))) != 0
            self.planes.append(np.packbits(b, bitorder="little"))
            high = a[b]
            zeros = self.n - len(high)
            out[:zeros], out[zeros:] = a[~b], high
            a, out = out, a

    @classmethod
    def of_planes(cls, planes: list[np.ndarray], n: int) -> WaveletMatrix:
        self = cls.__new__(cls)
        self.n, self.bits, self.planes = n, len(planes), planes
        return self

    def __getattr__(self, name: str):
        if name not in ("words", "ones", "zeros"):
            raise AttributeError(name)
        self.words, self.ones, self.zeros = [], [], []  # the directory, made when it is first asked for
        for p in self.planes:
            w = np.zeros(self.n // 64 + 1, np.uint64)
            w.view(np.uint8)[: len(p)] = p
            self.words.append(w)
            count = np.concatenate([[0], np.cumsum(np.bitwise_count(w), dtype=np.int64)])
            self.ones.append(count)
            self.zeros.append(self.n - int(count[-1]))
        return getattr(self, name)

    def _rank1(self, level: int, i: np.ndarray) -> np.ndarray:
        """Ones of a plane before each position."""
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.ones[level][i >> 6] + np.bitwise_count(self.words[level][i >> 6] & below)

    def _bit(self, level: int, i: np.ndarray) -> np.ndarray:
        return (self.words[level][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0

    def _select(self, level: int, k: np.ndarray, one: bool) -> np.ndarray:
        before = self.ones[level] if one else 64 * np.arange(len(self.ones[level])) - self.ones[level]
        at = np.searchsorted(before, k, "right") - 1
        words = self.words[level][at]
        return 64 * at + bit_at(words if one else ~words, k - before[at])

    def decode(self) -> np.ndarray:
        """All symbols in order, by undoing the partitions from the last level."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        a = np.zeros(self.n, kind)
        for level in reversed(range(self.bits)):
            b = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            out = np.empty(self.n, kind)
            zeros = self.n - int(np.count_nonzero(b))
            out[~b] = a[:zeros]
            out[b] = a[zeros:] | kind(1 << (self.bits - 1 - level))
            a = out
        return a.astype(np.uint32)
