"""Word and n-gram hashes of whole Arrow batches in numpy: no Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 2**64))
_PLACES = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | U(1)
CHUNK = 1 << 18
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: every bit depends on all bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``n`` at least."""
    size = max(n, 2 * CHUNK)
    if size > 2 * CHUNK:  # a single word longer than a chunk: not worth keeping
        return tuple(np.cumprod(np.full(size, x, np.uint64)) for x in (_BASE, _INVERSE))
    if size not in _POWERS:
        _POWERS[size] = tuple(np.cumprod(np.full(size, x, np.uint64)) for x in (_BASE, _INVERSE))
    return _POWERS[size]


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, wherever it stands. Spans are ascending and don't overlap."""
    out, i = np.zeros(len(begin), np.uint64), 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(end, begin[i] + CHUNK, "right")))
        at, to = int(begin[i]), int(end[j - 1])
        powers, inverses = _powers(to - at + 1)
        total = np.zeros(to - at + 1, np.uint64)
        np.cumsum(_BYTE[data[at:to]] * powers[: to - at], out=total[1:])
        out[i:j] = (total[end[i:j] - at] - total[begin[i:j] - at]) * inverses[begin[i:j] - at]
        i = j
    return mix(out + U(1))


def words(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text, with A-Z lower-cased.

    Returns (hash of each word, first word of each text with the total last,
    byte where each word begins in its text, byte where it ends).
    """
    data, offsets = buffers(texts)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    bounds = np.searchsorted(begin, offsets)
    base = np.repeat(offsets[:-1], np.diff(bounds))
    return span_hashes(lowered(data), begin, end), bounds, begin - base, end - base


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about ``max_bytes``, a single longer text being a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
    offsets, at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words that begin at each word (the last ``k - 1`` places are not runs)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out += h[i : i + n] * _PLACES[i]
    return mix(out)


def shingle_sets(texts: pa.Array | pa.ChunkedArray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ``k``-word shingle hashes of each text, one after the other, and where each text's begin.

    A text of fewer words has its whole sequence as its one shingle; one
    without words has none.
    """
    h, bounds, _, _ = words(texts)
    grams, sets = runs(h, k), []
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if b - a >= k:
            sets.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            whole = (h[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64) + U(b - a)
            sets.append(mix(np.array([whole], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    sizes = np.array([len(x) for x in sets], np.int64)
    starts = np.zeros(len(sets) + 1, np.int64)
    np.cumsum(sizes, out=starts[1:])
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), starts
