"""Vectors of Arrow batches as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(float64 matrix of the usable rows, their places): usable is not null, not empty, finite throughout and not zero.

    Rows of another length than the batch's most common one are not usable.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = column.to_pylist() if column.null_count or column.flatten().null_count else None
    if rows is None and len(column):
        offsets = column.offsets.to_numpy()
        sizes = np.diff(offsets)
        if (sizes == sizes[0]).all() and sizes[0]:
            x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, sizes[0])
            ok = np.isfinite(x).all(1) & (x != 0).any(1)
            return x[ok], np.flatnonzero(ok)
        rows = column.to_pylist()
    rows = rows or []
    sizes = [len(r) for r in rows if r]
    if not sizes:
        return np.zeros((0, 0)), np.zeros(0, np.int64)
    width = int(np.bincount(sizes).argmax())
    at = [i for i, r in enumerate(rows) if r is not None and len(r) == width and None not in r]
    x = np.array([rows[i] for i in at], np.float64).reshape(-1, width)
    ok = np.isfinite(x).all(1) & (x != 0).any(1)
    return x[ok], np.array(at, np.int64)[ok]


def by_width(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``matrix`` of the rows of each width, with places in the whole column."""
    if column.null_count:
        sizes = np.array([len(r) if r is not None else 0 for r in column.to_pylist()], np.int64)
    else:
        sizes = np.diff(column.offsets.to_numpy())
    for width in np.unique(sizes):
        own = np.flatnonzero(sizes == width)
        x, at = matrix(column.take(pa.array(own)) if len(own) < len(column) else column)
        if len(at):
            yield x, own[at]


def rotation(width: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    return q * np.sign(np.diag(r))
