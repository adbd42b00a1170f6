"""Hashes of words and word windows, computed over whole Arrow columns at once.

A word is a run of bytes other than space and \\x09-\\x0D; A-Z count as a-z.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_ONE = np.uint64(1)
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_STEP = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the input (splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _letter_values() -> np.ndarray:
    """A value per byte: none for spaces, the same for both cases of A-Z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP)) | _ONE
    values[65:91] = values[97:123]
    values[_SPACES] = 0
    return values


_VALUES = _letter_values()


def _powers_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if len(_powers[0]) < size:
        for i, base in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
            grown = np.full(size, base, np.uint64)
            grown[0] = 1
            _powers[i] = np.multiply.accumulate(grown)
    return _powers[0][:size], _powers[1][:size]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row's begin (one offset more than rows)."""
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.empty(0, np.uint8), np.zeros(len(at), np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and the number of words of each row (null: none)."""
    if texts.null_count:
        texts = texts.fill_null("")
    data, offsets = _bytes_of(texts)
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    solid = ~_SPACES[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = solid[begins]
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return np.empty(0, np.uint64), counts
    up, down = _powers_to(len(data))
    sums = np.add.reduceat(_VALUES[data] * up, starts)
    return mix(sums * down[starts]), counts


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbouring hashes (rows' borders are ignored)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = mix(total + hashes[i : i + n] + np.uint64(i + 1))
    return total


def long_windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """The same at a cost that does not grow with ``size``: differences of running polynomial sums."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _powers_to(len(hashes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up)])
    return mix((sums[size:] - sums[:-size]) * down[:n])


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes of each row, and how many each has; a shorter row with any
    word has its whole sequence as its one window."""
    starts = np.cumsum(counts) - counts
    inside = np.repeat(starts + counts, counts) - np.arange(len(hashes)) >= size
    found = windows(hashes, size)
    long = found[inside[: len(found)]]
    per_row = np.maximum(counts - size + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not len(short):
        return long, per_row
    at = np.cumsum(per_row)[short]
    whole = np.array([mix(np.array([np.add.reduce(windows(hashes[starts[r] : starts[r] + counts[r]], int(counts[r])))], np.uint64) + np.uint64(counts[r]))[0] for r in short], np.uint64)
    per_row[short] = 1
    return np.insert(long, at, whole), per_row


def sorted_sets(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row in ascending order, and how many each has."""
    row = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[new], np.bincount(row[new], minlength=len(counts))
