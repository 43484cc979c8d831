"""Vectorised words over Arrow text columns.

A word is a run of ASCII letters, digits and bytes of 0x80 and more; A-Z count as
a-z. All of it works on the UTF-8 buffer of a column, in slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _WORD[_a:_b] = True
_POW: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) <= n:
        size = 1 << (n + 1).bit_length()
        for i, p in enumerate((_P, _PINV)):
            x = np.full(size, p, U64)
            x[0] = 1
            _POW[i] = np.multiply.accumulate(x)
    return _POW[0], _POW[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, on a copy."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + n + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of rows of about ``most`` bytes; a longer text is a run of its own."""
    data, off = buffers(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


class Words:
    """Words of some texts laid end to end: ``start``, ``end`` (bytes), ``hash``, and ``first`` (word offsets of each text)."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        w = _WORD[data]
        n = len(w)
        begin, last = w.copy(), w.copy()
        if n:
            begin[1:] &= ~w[:-1]
            last[:-1] &= ~w[1:]
            cut = off[:-1][(off[:-1] < off[1:])]
            begin[cut] = w[cut]
            cut = off[1:][(off[:-1] < off[1:])] - 1
            last[cut] = w[cut]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, off)
        up, down = _powers(n + 1)
        c = np.zeros(n + 1, U64)
        low = _LOWER[data].astype(U64)
        low += U64(1)
        low *= up[:n]
        np.cumsum(low, out=c[1:])
        self._sums, self._down = c, down
        self.hash = self.part(self.start, self.end)

    def part(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of the lower-cased bytes from ``lo`` to ``hi``."""
        return mix((self._sums[hi] - self._sums[lo]) * self._down[lo] + (hi - lo).astype(U64) * U64(0xD6E8FEB86659FD93))

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Position of the first word and hash, for every run of ``k`` words within a text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        h = np.zeros(n, U64)
        for i in range(k):
            h *= U64(0x9FB21C651E98DF25)
            h += self.hash[i : i + n]
        ends = np.repeat(self.first[1:], np.diff(self.first))[:n]
        at = np.flatnonzero(np.arange(n) + k <= ends)
        return at, mix(h[at])

    def content(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each text's word sequence (0 without words)."""
        n = len(self.hash)
        up, down = _powers(n + 1)
        out = []
        lo, hi = self.first[:-1], self.first[1:]
        for salt in (0x1B873593, 0xCC9E2D51):
            c = np.zeros(n + 1, U64)
            np.cumsum(mix(self.hash + U64(salt)) * up[:n], out=c[1:])
            h = mix((c[hi] - c[lo]) * down[lo] + (hi - lo).astype(U64))
            out.append(np.where(hi > lo, h, U64(0)))
        return out[0], out[1]
