"""Runs of letters in whole texts, counted slice by slice in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def any_letter(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to a run of ASCII letters and characters beyond ASCII."""
    return (data >= 0x80) | latin_letter(data, wide=False)


def latin_letter(data: np.ndarray, wide: bool = True) -> np.ndarray:
    """Which bytes belong to A-Z, a-z or, if ``wide``, U+00C0 to U+00FF (those whose first byte is C3)."""
    small = data | np.uint8(32)
    inside = (small >= 97) & (small <= 122)
    if wide:
        inside |= data == 0xC3
        inside[1:] |= data[:-1] == 0xC3
    return inside


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(byte where each maximal run begins, where it ends, first run of each text with the total last)."""
    padded = np.zeros(len(inside) + 2, bool)
    padded[1:-1] = inside
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    begin = np.flatnonzero(padded[1:] & (~padded[:-1] | edge))
    end = np.flatnonzero(padded[:-1] & (~padded[1:] | edge))
    return begin, end, np.searchsorted(begin, offsets)


def take(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of the spans one after the other, where each begins with the total last)."""
    ends = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    return data[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])], ends


def strings(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    """The spans as an Arrow column of strings."""
    flat, ends = take(data, begin, size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))).cast(pa.string())
