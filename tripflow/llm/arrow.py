"""Arrow helpers for functions that run in Python workers."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are taken apart in slices of about so many bytes, which bounds a worker's memory.
SLICE_BYTES = 4 << 20


def flat(texts: pa.Array) -> pa.Array:
    """One array of strings with 64-bit offsets that start at 0, null replaced by the empty text.

    Casting a slice keeps the offsets of the whole, which Arrow's string functions don't all stand: ``ascii_lower``
    then gives offsets that point behind its data. The bytes are shared, not copied.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return texts
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not offsets[0]:
        return texts
    return pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(offsets - offsets[0]), data.slice(offsets[0], offsets[-1] - offsets[0])
    )


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of consecutive parts of at most ``most`` bytes, or of one longer text; only a part is copied."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, flat(texts.slice(start, stop - start))
        start = stop


def tokens(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The non-empty strings of an array of lists, and the number of the list that each is from."""
    values, rows = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    keep = pc.greater(pc.binary_length(values), 0)
    return values.filter(keep), rows[keep.to_numpy(zero_copy_only=False)]


def sparing(run: Callable) -> Callable:
    """``run``, a generator over batches, that hands freed memory back to the system when it ends.

    Python workers wait for more tasks, and what they keep meanwhile counts against the executor.
    """

    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return wrapped
