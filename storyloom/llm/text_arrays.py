"""Words, n-grams and their 64-bit hashes for Arrow string columns, as NumPy array operations.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D. Texts are cut into slices of about
``SLICE_BYTES`` (a longer text makes a slice of its own), so that the arrays stay small.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES, SLICE_ROWS = 1 << 20, 4096
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20240531).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWERED = _BYTES.copy()
_LOWERED[65:91] = _BYTES[97:123]
_powers = np.ones(1, np.uint64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets; a null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def release() -> None:
    """Give freed memory back to the system; Spark keeps Python workers for later tasks, of this job or of others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text, or a single longer text; then release memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            stop = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(ends, done + limit, "right"))))
            yield batch.slice(at, stop - at)
            at = stop
    release()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        more = np.full(max(n, 1024, 2 * len(_powers)), _BASE)
        more[0] = 1
        _powers = np.multiply.accumulate(more)
    return _powers


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte spans that do not overlap and ascend; ``lower`` folds A-Z."""
    lengths = ends - starts
    if not len(lengths):
        return np.zeros(0, np.uint64)
    firsts = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    values = (_LOWERED if lower else _BYTES)[data[np.repeat(starts, lengths) + within]]
    values *= powers(int(lengths.max()) + 1)[within]
    full = lengths > 0
    sums = np.zeros(len(lengths), np.uint64)
    if full.any():
        sums[full] = np.add.reduceat(values, firsts[full])
    return mix(sums ^ (lengths.astype(np.uint64) << np.uint64(40)))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = ~_WHITE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def ngrams(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words of one text, and the index of their first word."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(hashes) - n + 1
    acc = hashes[:m].copy()
    for j in range(1, n):
        acc *= _BASE
        acc += hashes[j : j + m]
    at = np.flatnonzero(doc[:m] == doc[n - 1 :])
    return mix(acc[at]), at


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges [start, start + length), one after the other."""
    firsts = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - firsts, lengths)


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values are among ``of``, by sorting (np.isin may hash, which is slow for 64-bit hashes)."""
    if not len(of):
        return np.zeros(len(values), bool)
    of = np.sort(of)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values
