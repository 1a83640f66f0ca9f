"""Arrow and numpy helpers of operators that work on many rows together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def row_runs(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows, given where each begins and the last ends: `most` at most, or one row."""
    lo, n = 0, len(ends) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def gather(values, first, count, which) -> tuple[np.ndarray, np.ndarray]:
    """The runs `values[first:first + count]` of all `which`, and where each ends."""
    n = count[which]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[which] - (ends - n), n)
    return values[at], ends


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (large strings), and where each begins and the last ends."""
    ends = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[ends[0] : ends[-1]] if held else np.empty(0, np.uint8)
    return data, ends - ends[0]


def text_chunks(batch: pa.RecordBatch, name: str, most: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of a batch of `most` bytes of text at most, or one row, with their texts; NULL as empty."""
    texts = batch.column(name).cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    for lo, hi in row_runs(ends, most):
        yield batch.slice(lo, hi - lo), pc.fill_null(texts.slice(lo, hi - lo), "")
        pa.default_memory_pool().release_unused()
