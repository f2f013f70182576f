"""Words of a batch of texts as exact numbers: where they stand, and which are equal, without hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def spans(data: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of the longest stretches of bytes for which `inside[byte]` holds; none crosses a text."""
    held = np.zeros(len(data) + 2, bool)
    held[1:-1] = inside[data]
    start = held[1:] & ~held[:-1]
    end = held[:-1] & ~held[1:]
    cuts = ends[1:-1]
    cuts = cuts[held[1:][cuts] & held[cuts]]  # a stretch goes on over the border of two texts
    start[cuts], end[cuts] = True, True
    start, end = np.flatnonzero(start), np.flatnonzero(end)
    return start, end, np.searchsorted(ends, start, "right") - 1


def packed(data: np.ndarray, start: np.ndarray, end: np.ndarray, inside: np.ndarray) -> pa.Array:
    """The spans that `spans` found in `data` as an Arrow array of binary values."""
    ends = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=ends[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data[inside[data]])])
