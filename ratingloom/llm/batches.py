"""Arrow batches cut into pieces of bounded text size, and small array helpers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Characters of text that one piece of work holds at once, unless one text alone is longer.
PIECE_CHARS = 2_000_000


def unused(names: list[str], wanted: str) -> str:
    """``wanted``, with as many underscores before it as make it differ from ``names``."""
    while wanted in names:
        wanted = f"_{wanted}"
    return wanted


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_CHARS) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose ``column`` holds about ``limit`` bytes at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64) + 1)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work``, giving its memory back when a task ends: its process may serve other stages for long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Every index of the given ranges, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def list_column(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    """A list column whose rows take ``lengths`` values each from ``values``."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def grouped_tables(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Runs of equal values in the given columns, of sorted batches."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in names]
        changed = np.zeros(batch.num_rows, bool)
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        begins = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for begin, end in zip(begins[:-1], begins[1:]):
            name = tuple(c[begin] for c in columns)
            if current is not None and name != current:
                yield pa.Table.from_batches(held)
                held = []
            current = name
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)
