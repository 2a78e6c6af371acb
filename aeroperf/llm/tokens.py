"""Token ids of whole texts with the tokenizers library, which encodes each distinct piece of text once.

A byte-level BPE never joins across the cut before a single space between two
visible characters, nor across those around a single newline between them: its
pre-tokens end there whatever stands to the left. Texts are cut at such places
(only where the neighbouring characters are ASCII or of two bytes, which leaves
out all rarer white space), pieces not met before are encoded, and the ids of
the texts are gathered from a table in numpy. New pieces that begin and end at such
a cut are encoded thousands at a time as one text, and told apart by the bytes
that ids stand for. A piece is known by its 64-bit hash. Memory follows the batch and the table, which forgets at ``max_pieces``
what was not met lately; an overlong text needs no long encode.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from aeroperf.llm.hashing import buffers, span_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
_ENCODERS: dict[tuple[str, int], PieceEncoder] = {}


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin, with the end last. Empty texts have no piece."""
    n = len(data)
    if not n:
        return np.zeros(1, np.int64)
    plain, lead = (data > 32) & (data < 127), (data >= 0xC3) & (data <= 0xDF)
    ends_visible, begins_visible = plain.copy(), plain | lead
    ends_visible[1:] |= lead[:-1]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    between = np.zeros(n, bool)
    between[1:-1] = ends_visible[:-2] & begins_visible[2:] & ~edge[1 : n - 1] & ~edge[2:n]
    line = between & (data == 10)
    begin = edge.copy()
    begin[:n] |= between & (data == 32) | line
    begin[1:] |= line
    begin[n] = True
    return np.flatnonzero(begin)


def _gather(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces of ``flat`` that begin and are as long as said, one after the other."""
    ends = np.cumsum(size, dtype=np.int64)
    return flat[np.repeat(begin - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)]


class _Table:
    """Ids of pieces by the pieces' hashes, which are sorted."""

    def __init__(self, kind: type):
        self.keys, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, kind), 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each key, whether it is there)."""
        where = np.searchsorted(self.keys, keys)
        if not len(self.keys):
            return where, np.zeros(len(keys), bool)
        return where, self.keys[np.minimum(where, len(self.keys) - 1)] == keys

    def add(self, keys: np.ndarray, size: np.ndarray, flat: np.ndarray) -> None:
        """Sorted keys that are not there yet, and their ids one after the other."""
        while len(self.flat) < self.used + len(flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(flat)] = flat
        where = np.searchsorted(self.keys, keys)
        self.begin = np.insert(self.begin, where, self.used + np.cumsum(size) - size)
        self.keys, self.size = np.insert(self.keys, where, keys), np.insert(self.size, where, size)
        self.used += len(flat)


class PieceEncoder:
    def __init__(self, path: str, max_pieces: int = 1_600_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.max_pieces = Tokenizer.from_file(path), max_pieces
        vocabulary, last = self.tokenizer.get_vocab(with_added_tokens=False), max([*self.tokenizer.get_vocab().values(), 0])
        self.kind = np.uint16 if last < 1 << 16 else np.uint32
        self.young, self.old = _Table(self.kind), _Table(self.kind)  # what is met moves from old to young; a full young becomes old
        self.bytes_of = np.zeros(last + 1, np.int64)
        self.bytes_of[list(vocabulary.values())] = [len(x) for x in vocabulary]  # a byte is a character of the vocabulary

    def _singly(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, the ids)."""
        ids = [x.ids for x in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return sizes, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))

    def _joined(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces that may follow one another."""
        ids = np.array(self.tokenizer.encode_batch_fast([b"".join(pieces).decode()], add_special_tokens=False)[0].ids, np.uint32)
        ends, own = np.cumsum(self.bytes_of[ids]), np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        last = np.searchsorted(ends, own)
        if not len(ids) or ends[-1] != own[-1] or (ends[last] != own).any():  # a vocabulary of another kind
            return self._singly(pieces)
        return np.diff(last + 1, prepend=0), ids

    def _learn(self, keys: np.ndarray, data: np.ndarray, at: np.ndarray, to: np.ndarray) -> None:
        raw = data.tobytes()
        second, last = data[np.minimum(at + 1, len(data) - 1)], data[to - 1]
        opens = (data[at] == 32) & (to - at > 1) & (((second > 32) & (second < 127)) | ((second >= 0xC3) & (second <= 0xDF)))
        before = data[np.maximum(to - 2, 0)]
        closes = ((last > 32) & (last < 127)) | ((before >= 0xC3) & (before <= 0xDF) & (last >= 0x80))
        for kind, chunk, encode in ((opens & closes, 5_000, self._joined), (~(opens & closes), 10_000, self._singly)):
            own = np.flatnonzero(kind)
            got = [encode([raw[a:b] for a, b in zip(at[some].tolist(), to[some].tolist())]) for some in (own[i : i + chunk] for i in range(0, len(own), chunk))]
            if got:
                self.young.add(keys[own], *map(np.concatenate, zip(*got)))

    def encode(self, texts: pa.Array, end_id: int | None = 0) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other as uint32, where each text's begin with the total last).

        A null is an empty text. ``end_id`` is appended to every text, unless None.
        """
        data, offsets = buffers(texts)
        at = cuts(data, offsets)
        at, to = at[:-1], at[1:]
        keys, first, back = np.unique(span_hashes(data, at, to), return_index=True, return_inverse=True)
        if len(self.young.keys) + len(keys) > self.max_pieces // 2:
            self.young, self.old = _Table(self.kind), self.young
        where, known = self.young.find(keys)
        if not known.all():
            missing = np.flatnonzero(~known)
            before, held = self.old.find(keys[missing])
            before = before[held]
            self.young.add(keys[missing[held]], self.old.size[before], _gather(self.old.flat, self.old.begin[before], self.old.size[before]))
            new = missing[~held]
            if len(new):
                self._learn(keys[new], data, at[first[new]], to[first[new]])
            where = np.searchsorted(self.young.keys, keys)
        begin, size = self.young.begin[where][back].astype(np.int64), self.young.size[where][back].astype(np.int64)
        bounds = np.searchsorted(at, offsets)
        ends = np.concatenate([[0], np.cumsum(size)])
        starts = ends[bounds] + (np.arange(len(offsets)) if end_id is not None else 0)
        ids = _gather(self.young.flat, begin, size).astype(np.uint32)
        if end_id is None:
            return ids, starts
        out = np.full(len(ids) + len(offsets) - 1, end_id, np.uint32)
        keep = np.ones(len(out), bool)
        keep[starts[1:] - 1] = False
        out[keep] = ids
        return out, starts


def encoder(path: str, max_pieces: int = 1_600_000) -> PieceEncoder:
    """The process's encoder for a vocabulary file; workers that are used again keep it."""
    if (path, max_pieces) not in _ENCODERS:
        _ENCODERS[path, max_pieces] = PieceEncoder(path, max_pieces)
    return _ENCODERS[path, max_pieces]
