"""Packing: best-fit decreasing into windows of a fixed number of tokens.

Documents are encoded where they lie; what is shuffled are narrow rows, one per
piece. A document longer than a window is first cut into full windows, each a
sequence of its own, and its rest is packed with the other documents: longest
first, into the open window with the least room that still fits. A segment tree
over remaining capacities 0..window finds that window in log(window) steps.
Each shuffle partition is packed on its own, so work and memory follow the
partition; the padding that this costs is less than a window or two for each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from aeroperf.llm.hashing import slices
from aeroperf.llm.tokens import encoder
from aeroperf.llm.workers import tidy


class CapacityTree:
    """Open windows by remaining capacity; ``take(n)`` gives the tightest with room for ``n``."""

    def __init__(self, window: int):
        self.leaf = 1 << window.bit_length()
        self.filled = [0] * (2 * self.leaf)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, by: int) -> None:
        at, filled = capacity + self.leaf, self.filled
        while at:
            filled[at] += by
            at >>= 1

    def put(self, capacity: int, window: int) -> None:
        if capacity:
            self.open[capacity].append(window)
            self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, window) with the least capacity of at least ``least``; it is no longer open."""
        at, filled = least + self.leaf, self.filled
        while not filled[at]:  # up, until a subtree to the right holds an open window
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
            if at & (at - 1) == 0:  # went round the right end
                return None
        while at < self.leaf:
            at = 2 * at + (not filled[2 * at])
        capacity = at - self.leaf
        self._add(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of each piece, its offset there). ``lengths`` are in descending order, each of 1..window."""
    tree, opened = CapacityTree(window), 0
    which, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        found = tree.take(n)
        if found is None:
            found, opened = (window, opened), opened + 1
        capacity, at = found
        which[i], offset[i] = at, window - capacity
        tree.put(capacity - n, at)
    return which, offset


def _pieces(path: str, window: int, id_col: str, text_col: str, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in (part for b in batches for part in slices(b, text_col)):
            ids, starts = encode(batch.column(text_col), end_id)
            raw, sizes = memoryview(np.ascontiguousarray(ids, "<u4").view(np.uint8)), np.diff(starts)
            counts = -(-sizes // window)
            doc = np.repeat(np.arange(len(sizes)), counts)
            begin = (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)) * window
            length = np.minimum(window, sizes[doc] - begin)
            at = starts[doc] + begin
            parts = [raw[4 * a : 4 * (a + n)] for a, n in zip(at.tolist(), length.tolist())]
            columns = [batch.column(id_col).take(pa.array(doc)), pa.array(begin), pa.array(length), pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(sizes[doc])]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns.append(pa.array([bytes(p) for p in parts], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _packed(window: int, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if not got:
            return
        table = pa.Table.from_batches(got).sort_by([("length", "descending"), (id_col, "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        length = table.column("length").to_numpy()
        which, offset = best_fit_decreasing(length, window)
        used = np.bincount(which, length).astype(np.int64)
        single = (used & (used - 1)) == 0
        sequence = (np.int64(TaskContext.get().partitionId()) << 33) + which
        for name, x in (("sequence_id", sequence), ("offset", offset), ("sequence_tokens", used[which]), ("padded_to", np.where(single, used, window)[which])):
            table = table.append_column(name, pa.array(x, pa.int64()))
        yield from table.to_batches(max_chunksize=10_000)

    return run


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """One row per piece of a document: where it begins, its length and checksum, its sequence and offset there.

    A null text is an empty one and, like it, packed as its end id alone.
    Repeated rows and null ids are packed as any other. A sequence is padded to
    ``window``, except one whose length is a power of two (``padded_to``). An
    empty table gives no row. Other columns of ``docs`` are not carried.
    With ``keep_ids`` each piece's ids follow as little-endian unsigned 32-bit
    integers.
    """
    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * keep_ids
    pieces = docs.select(id_col, text_col).mapInArrow(tidy(_pieces(tokenizer, window, id_col, text_col, end_id, keep_ids)), schema)
    dealt = docs.sparkSession.sql(f"SELECT /*+ REBALANCE(`{id_col}`, start) */ * FROM {{pieces}}", pieces=pieces)
    return dealt.mapInArrow(tidy(_packed(window, id_col)), schema + ", sequence_id long, offset long, sequence_tokens long, padded_to long")
