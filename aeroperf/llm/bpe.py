"""Byte-level BPE by a table of ranks, encoded and decoded by DuckDB queries in each partition.

A row for each token of a word, at its position. A recursive query joins the
rows with the merge table (every two tokens that make up a third), contracts the
leftmost pair of the lowest rank of each word, and goes on until no word has a
pair. Decoding joins tokens with their bytes and aggregates in order.

Both are done once for each distinct word (a match of the pattern; tokens up to
the next that begins with a blank): words are known by their 64-bit hash, and a
worker remembers what it met lately, in narrow arrays of a fixed bound. DuckDB
runs in memory, on one thread, over chunks whose recursion makes about
``_ROWS`` rows; words too long for one chunk go on from where the last
recursion stopped. In long words all equal pairs are contracted at once, where
that is the same: unless a token of a lower rank begins or ends with theirs.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from aeroperf.llm.columns import fresh
from aeroperf.llm.hashing import buffers, slices, span_hashes
from aeroperf.llm.runs import take
from aeroperf.llm.storage import open_fs
from aeroperf.llm.tokens import _Table, cuts
from aeroperf.llm.workers import tidy

#: Rows that one recursion may make, about.
_ROWS = 2_000_000
#: Words of more bytes contract all equal pairs at once.
_LONG = 48

#: The leftmost pair of the lowest rank. ``score``: rank and position.
_ONE = """
SELECT w, pos, CASE WHEN score = best THEN (score >> 32)::INT ELSE id END AS id, step + 1 AS step FROM (
  SELECT *, min(score) OVER (PARTITION BY w) AS best FROM (
    SELECT p.*, (m.id::BIGINT << 32) + p.pos AS score
    FROM (SELECT *, lead(id) OVER a AS next_id, lag(pos) OVER a AS last_pos FROM {t} WINDOW a AS (PARTITION BY w ORDER BY pos)) p LEFT JOIN merges m ON m.l = p.id AND m.r = p.next_id))
WHERE best IS NOT NULL AND (last_pos IS NULL OR best & 4294967295 <> last_pos)
"""
#: All pairs of the lowest rank, of overlapping ones the first, third and so on; of those that have to go one by one, the leftmost.
_ALL = """
SELECT w, pos, CASE WHEN hit THEN rank ELSE id END AS id, step + 1 AS step FROM (
  SELECT *, coalesce(lag(hit) OVER (PARTITION BY w ORDER BY pos), false) AS gone FROM (
    SELECT *, coalesce(equal AND (place - coalesce(max(CASE WHEN equal THEN NULL ELSE place END) OVER (PARTITION BY w ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)) % 2 = 1, false) AS hit FROM (
      SELECT *, coalesce(rank = best >> 32 AND (NOT single OR pos = best & 4294967295), false) AS equal FROM (
        SELECT *, min((rank::BIGINT << 32) + pos) OVER (PARTITION BY w) AS best FROM (
          SELECT p.*, m.id AS rank, m.single
          FROM (SELECT *, lead(id) OVER a AS next_id, row_number() OVER a AS place FROM {t} WINDOW a AS (PARTITION BY w ORDER BY pos)) p LEFT JOIN merges m ON m.l = p.id AND m.r = p.next_id)))))
WHERE best IS NOT NULL AND NOT gone
"""
_UNTIL = "WITH RECURSIVE t AS (SELECT w, pos, id, 0 AS step FROM base UNION ALL (SELECT * FROM ({contract}) WHERE step <= {most})) SELECT w, pos, id, step FROM t QUALIFY step = max(step) OVER (PARTITION BY w) ORDER BY w, pos"
_DECODE = "SELECT w, unhex(string_agg(x, '' ORDER BY pos)) AS bytes FROM base JOIN vocabulary USING (id) GROUP BY w ORDER BY w"


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file of lines ``base64 rank``."""
    fs, at = open_fs(path)
    with fs.open_input_stream(at) as f:
        lines = f.read().split(b"\n")
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_rows(ranks: dict[bytes, int]) -> list[tuple[int, int, int, bool]]:
    """(left, right, both, single): every two tokens that make up a third. ``single``: a token of a lower rank begins or ends with ``both``."""
    single = set()
    for token, rank in ranks.items():
        for part in chain.from_iterable((token[:i], token[i:]) for i in range(1, len(token))):
            if ranks.get(part, -1) > rank:
                single.add(ranks[part])
    splits = ((token[:i], token[i:], rank) for token, rank in ranks.items() for i in range(1, len(token)))
    return [(ranks[a], ranks[b], rank, rank in single) for a, b, rank in splits if a in ranks and b in ranks]


class Memo:
    """What spans of bytes stand for, learnt once for each distinct span; forgets at ``most`` spans what was not met lately."""

    def __init__(self, kind: type, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int):
        """learn: distinct spans to (number of values of each, the values)."""
        self.kind, self.learn, self.most = kind, learn, most
        self.young, self.old = _Table(kind), _Table(kind)

    def look_up(self, data: np.ndarray, at: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of values of each span, the values one after the other)."""
        keys, first, back = np.unique(span_hashes(data, at, to), return_index=True, return_inverse=True)
        if len(self.young.keys) + len(keys) > self.most // 2:
            self.young, self.old = _Table(self.kind), self.young
        missing = np.flatnonzero(~self.young.find(keys)[1])
        before, held = self.old.find(keys[missing])
        before = before[held]
        self.young.add(keys[missing[held]], self.old.size[before], take(self.old.flat, self.old.begin[before], self.old.size[before])[0])
        new = missing[~held]
        if len(new):
            raw = data.tobytes()
            size, values = self.learn([raw[a:b] for a, b in zip(at[first[new]].tolist(), to[first[new]].tolist())])
            self.young.add(keys[new], size, values)
        where = np.searchsorted(self.young.keys, keys)[back]
        size = self.young.size[where].astype(np.int64)
        return size, take(self.young.flat, self.young.begin[where].astype(np.int64), size)[0]


class Coder:
    """Encodes and decodes texts by the ranks of a file; a process keeps one for each file."""

    def __init__(self, path: str, pattern: str, most: int = 1_600_000):
        import duckdb
        import regex

        self.ranks, self.pattern = read_ranks(path), regex.compile(pattern)
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        ids = np.fromiter(self.ranks.values(), np.int32, len(self.ranks))
        self.blank = np.zeros(int(ids.max()) + 1, bool)
        self.blank[ids] = [token[:1] in (b" ", b"\n") for token in self.ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        merges = [np.array(x) for x in zip(*merge_rows(self.ranks))] or [np.zeros(0, np.int32)] * 4
        self._table("merges", l=merges[0].astype(np.int32), r=merges[1].astype(np.int32), id=merges[2].astype(np.int32), single=merges[3].astype(bool))
        self._table("vocabulary", id=ids, x=[token.hex() for token in self.ranks])
        self.pieces, self.words = Memo(np.uint32, self._of_pieces, most), Memo(np.uint32, self._of_words, most)
        self.runs = Memo(np.uint8, self._of_runs, most)

    def _table(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's begin with the total last). A null is an empty text."""
        data, offsets = buffers(texts)
        at = cuts(data, offsets)
        size, ids = self.pieces.look_up(data, at[:-1], at[1:])
        ends = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        return ids, ends[np.searchsorted(at[:-1], offsets)]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts one after the other, where each text's begin with the total last)."""
        edge = np.zeros(len(ids) + 1, bool)
        edge[:-1] = self.blank[ids]
        edge[starts] = True
        at = np.flatnonzero(edge[:-1])
        to = np.append(at[1:], len(ids))[: len(at)]
        size, out = self.runs.look_up(ids.astype("<u4").view(np.uint8), 4 * at, 4 * to)
        ends = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        return out, ends[np.searchsorted(at, starts)]

    def _of_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches of text that no match of the pattern crosses."""
        words = [self.pattern.findall(piece.decode()) for piece in pieces]
        raw = [w.encode() for w in chain.from_iterable(words)]
        ends = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)), out=ends[1:])
        size, ids = self.words.look_up(np.frombuffer(b"".join(raw), np.uint8), ends[:-1], ends[1:])
        bounds, total = np.cumsum([0, *map(len, words)]), np.concatenate([[0], np.cumsum(size)])
        return np.diff(total[bounds]), ids

    def _of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of single matches: the token that a match is, else what is left of its bytes when nothing can be contracted."""
        whole = [self.ranks.get(w) for w in words]
        size, out = np.ones(len(words), np.int64), [np.array([x or 0], np.uint32) for x in whole]
        rest = sorted((i for i, x in enumerate(whole) if x is None), key=lambda i: len(words[i]))
        at = 0
        while at < len(rest):
            to, rows = at, 0
            while to < len(rest) and (to == at or rows < _ROWS) and (len(words[rest[to]]) > _LONG) == (len(words[rest[at]]) > _LONG):
                rows += len(words[rest[to]]) ** 2 // 2
                to += 1
            chunk = rest[at:to]
            for i, ids in zip(chunk, self._contracted([words[i] for i in chunk])):
                out[i], size[i] = ids, len(ids)
            at = to
        return size, np.concatenate(out)

    def _contracted(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words of similar length."""
        data, size = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
        w = np.repeat(np.arange(len(words), dtype=np.int32), size)
        now = pa.table({"w": w, "pos": (np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32), "id": self.of_byte[data]})
        done: list[pa.Table] = []
        long = int(size.max()) > _LONG
        while len(now):
            most = max(1, _ROWS // len(now)) if long else int(size.max())
            self.db.register("base", now)
            got = self.db.sql(_UNTIL.format(contract=(_ALL if long else _ONE).format(t="t"), most=most)).to_arrow_table()
            open_ = pa.compute.equal(got.column("step"), most)  # these may go on
            done.append(got.filter(pa.compute.invert(open_)))
            now = got.filter(open_).drop_columns("step")
        got = pa.concat_tables(done).sort_by([("w", "ascending"), ("pos", "ascending")])
        own = got.column("w").to_numpy()
        return np.split(got.column("id").to_numpy().astype(np.uint32), np.searchsorted(own, np.arange(1, len(words))))

    def _of_runs(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of runs of ids."""
        size, out = [], []
        for i in range(0, len(runs), 50_000):
            some = runs[i : i + 50_000]
            n = np.fromiter((len(x) // 4 for x in some), np.int64, len(some))
            w = np.repeat(np.arange(len(some), dtype=np.int32), n)
            self.db.register("base", pa.table({"w": w, "pos": np.arange(len(w)), "id": np.frombuffer(b"".join(some), "<u4").astype(np.int32)}))
            data, offsets = buffers(self.db.sql(_DECODE).to_arrow_table().column("bytes"))
            size.append(np.diff(offsets))
            out.append(data)
        return np.concatenate(size), np.concatenate(out)


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Coder(path, pattern)
    return _CODERS[path, pattern]


def _binary(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(np.ascontiguousarray(starts)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def _coded(path: str, pattern: str, text: str | None, ids: str | None, names: list[str]):
    """texts to ids, ids to bytes, or texts to both."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            for part in slices(batch, text or ids, 1 << 22):
                if text:
                    flat, starts = own.encode(part.column(text))
                else:
                    raw, starts = buffers(part.column(ids))
                    flat, starts = np.frombuffer(raw.tobytes(), "<u4"), starts // 4
                new = [pa.array(np.diff(starts)), _binary(flat.astype("<u4").view(np.uint8), 4 * starts)] if text else []
                if len(names) > len(new):
                    new.append(_binary(*own.decode(flat, starts)))
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *names])

    return run


_KINDS = {"n_tokens": T.LongType(), "token_ids": T.BinaryType(), "decoded": T.BinaryType()}


def _run(df: DataFrame, path: str, pattern: str, text: str | None, ids: str | None, new: list[str]) -> DataFrame:
    names = fresh(df, *new)
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, _KINDS[k]) for n, k in zip(names, new))])
    return df.mapInArrow(_coded(path, pattern, text, ids, names), schema)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with n_tokens long and token_ids binary (little-endian unsigned 32-bit ids) of its whole texts.

    Each match of ``pattern`` is encoded by itself, by the ranks in ``path``
    (lines ``base64 rank``), without special tokens. The pattern has to end a
    match before a single blank and around a single newline that stand between
    visible characters, as those of byte-level BPE do. A null or empty text has
    no tokens; rows, nulls and repeats in other columns stay as they are; a new
    column whose name is taken gets underscores before it. An empty table stays
    empty. A text of any length is encoded whole; one task holds it.
    """
    return _run(df, path, pattern, text, None, ["n_tokens", "token_ids"])


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """``df`` with decoded binary, the bytes that its ids stand for; null or no ids give none."""
    return _run(df, path, pattern, None, ids, ["decoded"])


def encode_and_decode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``encode``, then ``decode`` of the ids, in one pass: one worker instead of two."""
    return _run(df, path, pattern, text, None, ["n_tokens", "token_ids", "decoded"])
