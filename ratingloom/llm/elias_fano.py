"""Elias-Fano coded monotone sequences, queried for many values at once.

A sequence of n whole numbers below u takes about 2 + log2(u / n) bits each: the
low bits as they are, the high bits as a unary-coded histogram.  A value is found
among its successors: its high part names a short run of low parts.
"""

from __future__ import annotations

import os
from typing import NamedTuple

import numpy as np

_BYTE_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits, one after the other, in 64-bit words (one spare)."""
    words = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if not width or not len(values):
        return words
    bit = np.arange(len(values), dtype=np.int64) * width
    word, shift = bit >> 6, (bit & 63).astype(np.uint64)
    # Bits of different values never overlap, so adding them is setting them.
    first = np.flatnonzero(np.diff(word, prepend=-1))
    words[word[first]] += np.add.reduceat(values << shift, first)
    spill = np.flatnonzero(shift + np.uint64(width) > np.uint64(64))
    words[word[spill] + 1] += values[spill] >> (np.uint64(64) - shift[spill])
    return words


class EliasFano(NamedTuple):
    size: int
    width: int
    low: np.ndarray  # packed low bits
    high: np.ndarray  # bytes of the unary part: per high value its elements as ones, then a zero
    zeros: np.ndarray  # zeros before every 64 bytes of it

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        """From ascending values below ``universe``."""
        n = len(values)
        width = min(62, max(0, (universe // max(1, n)).bit_length() - 1))
        high_values = (values >> np.uint64(width)).astype(np.int64)
        buckets = ((universe - 1) >> width) + 1 if universe else 1
        bits = np.zeros((n + buckets + 511) // 512 * 512, np.uint8)
        bits[high_values + np.arange(n)] = 1
        bits[n + buckets :] = 1  # no zeros beyond the last bucket's
        packed = np.packbits(bits, bitorder="little")
        ones = _BYTE_ONES[packed].reshape(-1, 64).sum(axis=1, dtype=np.int64)
        zeros = np.concatenate([[0], np.cumsum(512 - ones)])
        low = _pack(values & np.uint64((1 << width) - 1), width)
        return cls(n, width, low, packed, zeros)

    def save(self, folder: str, name: str) -> None:
        for part in ("low", "high", "zeros"):
            np.save(os.path.join(folder, f"{name}-{part}.npy"), getattr(self, part))

    def mapped(self, folder: str, name: str) -> EliasFano:
        """The same sequence on memory-mapped files written by ``save``."""
        return self._replace(**{p: np.load(os.path.join(folder, f"{name}-{p}.npy"), mmap_mode="r") for p in ("low", "high", "zeros")})

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        bit = i * self.width
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        value = self.low[word] >> shift
        over = shift + np.uint64(self.width) > np.uint64(64)
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << self.width) - 1)

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position of zero, or one, number k (from 0) of the unary part."""
        before = np.arange(len(self.zeros)) * 512 - self.zeros if ones else self.zeros
        block = np.searchsorted(before, k, side="right") - 1
        rest = (k - before[block]).astype(np.int16)
        at = block * 64
        step = 32
        # Halve the block's 64 bytes, then look into one byte.
        per_byte = _BYTE_ONES[self.high].reshape(-1, 64).astype(np.int16)
        prefix = np.cumsum(per_byte if ones else 8 - per_byte, axis=1, dtype=np.int16).ravel()
        begin = at.copy()
        while step:
            skip = prefix[at + step - 1] <= rest
            at = np.where(skip, at + step, at)
            step >>= 1
        rest = rest - np.where(at > begin, prefix[at - 1], 0)
        byte = self.high[at].astype(np.int16)
        found = np.zeros(len(k), np.int64)
        seen = np.zeros(len(k), np.int16)
        for bit in range(8):
            wanted = (byte >> bit) & 1 == (1 if ones else 0)
            found[wanted & (seen == rest)] = bit
            seen += wanted
        return at * 8 + found

    def find(self, values: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | None = None) -> np.ndarray:
        """Index of each value (first, if repeated) in the sequence, or -1.

        Only places from ``first`` to before ``last`` are looked at, where given.
        """
        if not self.size or not len(values):
            return np.full(len(values), -1, np.int64)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        begin = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) - high + 1, 0)
        end = self._select(high, False) - high
        begin = np.maximum(begin, first)
        end = np.maximum(begin, end if last is None else np.minimum(end, last))
        low = values & np.uint64((1 << self.width) - 1)
        # First element of the run whose low part is no less: its successor.
        left, right = begin.copy(), end.copy()
        while True:
            open_ = np.flatnonzero(left < right)
            if not len(open_):
                break
            middle = (left[open_] + right[open_]) >> 1
            less = self._low(middle) < low[open_]
            left[open_[less]] = middle[less] + 1
            right[open_[~less]] = middle[~less]
        hit = left < end
        hit[hit] = self._low(left[hit]) == low[hit]
        return np.where(hit, left, -1)

    def values(self, i: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        return ((self._select(i, True) - i).astype(np.uint64) << np.uint64(self.width)) | self._low(i)
