"""Token-id files under Re-Pair grammar compression, with random access to any document.

A file is a row of shards. In a shard, frequent pairs of neighbouring ids are
replaced by new symbols, round after round (several pairs at once, in rounds,
instead of one at a time), until no pair is met ``least`` times; the rules, the
lengths of their expansions and the documents' places are stored with it, so
that one document can be decoded without the others. No rule spans two documents.

Shard, little-endian: ``RPR2``, five unsigned 64-bit numbers (documents, rules,
symbols, ids, bit planes), then the documents' ids (int64), a byte each for "id
is null", their first symbols and first ids (uint64), the rules' left and right
symbols and expansion lengths (uint32), the first rule's symbol (uint64), the
symbols' lower 16 bits (uint16), and a plane of bits for each bit above those
that the largest symbol has.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aeroperf.llm.hashing import slices
from aeroperf.llm.storage import AtomicFile, list_files, make_folder, open_fs
from aeroperf.llm.tokens import encoder
from aeroperf.llm.workers import tidy

MAGIC = b"RPR2"
U = np.uint64


@dataclass
class Grammar:
    base: int  # symbols from here on are rules
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray  # of the rules' expansions


def repair(ids: np.ndarray, starts: np.ndarray, base: int, least: int = 12) -> tuple[np.ndarray, np.ndarray, Grammar]:
    """(symbols, first symbol of each document, rules) of a shard; ``starts`` are the documents' first ids with the total last.

    Ends when no pair is met ``least`` times. A rule takes 12 bytes and a
    replaced pair saves a symbol of 2 or more: at 12 every rule pays for itself.
    """
    s, first = ids.astype(np.uint32), starts.astype(np.int64)
    left, right, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)], np.zeros(0, np.uint32)
    while len(s) > 1:
        code = s[:-1].astype(np.uint64) << U(32) | s[1:]
        bucket = (code * U(0x9E3779B97F4A7C15)) >> U(46)
        whole = np.ones(len(code), bool)
        inner = first[1:-1]
        whole[inner[(inner > 0) & (inner < len(s))] - 1] = False
        at = np.flatnonzero(whole)
        counts = np.bincount(bucket[at].astype(np.int64), minlength=1 << 18)
        at = at[counts[bucket[at]] >= least]
        if not len(at):
            break
        pairs, back, n = np.unique(code[at], return_inverse=True, return_counts=True)
        chosen = np.flatnonzero(n >= least)
        if not len(chosen):
            break
        rank = np.full(len(pairs), -1)
        rank[chosen] = np.arange(len(chosen))
        use = rank[back] >= 0
        at, rule = at[use], rank[back][use]
        begins = np.r_[True, at[1:] != at[:-1] + 1]  # of runs of overlapping pairs: every second one is taken
        run = np.flatnonzero(begins)
        odd = (np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0
        at, rule = at[odd], rule[odd]
        taken = np.unique(rule)  # pairs that every overlap has lost get no rule
        symbol = np.zeros(len(chosen), np.uint32)
        symbol[taken] = base + len(lengths) + np.arange(len(taken))
        a, b = (pairs[chosen[taken]] >> U(32)).astype(np.uint32), (pairs[chosen[taken]] & U(0xFFFFFFFF)).astype(np.uint32)
        size = lambda x: np.where(x < base, 1, lengths[np.maximum(x.astype(np.int64) - base, 0)] if len(lengths) else 1)
        left.append(a)
        right.append(b)
        lengths = np.concatenate([lengths, (size(a) + size(b)).astype(np.uint32)])
        s[at] = symbol[rule]
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        first = np.concatenate([[0], np.cumsum(keep)])[first]
        s = s[keep]
    return s, first, Grammar(base, np.concatenate(left), np.concatenate(right), lengths)


def expand(symbols: np.ndarray, g: Grammar) -> np.ndarray:
    """The ids that symbols stand for; any slice of a shard's symbols can be given."""
    s = symbols.astype(np.uint32)
    while len(at := np.flatnonzero(s >= g.base)):
        wide = np.ones(len(s), np.int64)
        wide[at] = 2
        place = np.cumsum(wide) - wide
        rule = s[at].astype(np.int64) - g.base
        s = np.repeat(s, wide)
        s[place[at]], s[place[at] + 1] = g.left[rule], g.right[rule]
    return s


def _shard(keys: list[int | None], ids: np.ndarray, starts: np.ndarray) -> bytes:
    base = max(1, int(ids.max()) + 1 if len(ids) else 1)
    symbols, first, g = repair(ids, starts, base)
    planes = max(0, (base + len(g.lengths) - 1).bit_length() - 16)
    return b"".join((
        MAGIC, struct.pack("<5Q", len(keys), len(g.lengths), len(symbols), len(ids), planes),
        np.array([k or 0 for k in keys], "<i8").tobytes(), np.array([k is None for k in keys], np.uint8).tobytes(),
        first[:-1].astype("<u8").tobytes(), starts[:-1].astype("<u8").tobytes(),
        g.left.astype("<u4").tobytes(), g.right.astype("<u4").tobytes(), g.lengths.astype("<u4").tobytes(), struct.pack("<Q", g.base),
        symbols.astype("<u2").tobytes(), *(np.packbits((symbols >> (16 + i)) & 1).tobytes() for i in range(planes)),
    ))


class Shard:
    """A stored shard; ``document(i)`` decodes one document."""

    def __init__(self, head: tuple[int, ...], body: bytes):
        docs, rules, symbols, self.n_ids, planes = head
        at = 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, kind, n, at)
            at += out.nbytes
            return out

        keys, null = take("<i8", docs), take("u1", docs)
        self.keys = [None if x else int(k) for k, x in zip(keys, null)]
        self.first, self.starts = np.append(take("<u8", docs), symbols).astype(np.int64), np.append(take("<u8", docs), self.n_ids).astype(np.int64)
        left, right, lengths = (take("<u4", rules) for _ in range(3))
        self.grammar = Grammar(int(take("<u8", 1)[0]), left, right, lengths)
        self.symbols = take("<u2", symbols).astype(np.uint32)
        for i in range(planes):
            self.symbols |= np.unpackbits(take("u1", -(-symbols // 8)), count=symbols).astype(np.uint32) << (16 + i)

    def document(self, i: int) -> np.ndarray:
        return expand(self.symbols[self.first[i] : self.first[i + 1]], self.grammar)

    def token(self, i: int, at: int) -> int:
        """Id ``at`` of document ``i``, by the expansion lengths: only the rules on the way are opened."""
        for s in self.symbols[self.first[i] : self.first[i + 1]].tolist():
            size = 1 if s < self.grammar.base else int(self.grammar.lengths[s - self.grammar.base])
            if at < size:
                while s >= self.grammar.base:
                    rule = s - self.grammar.base
                    s = int(self.grammar.left[rule])
                    size = 1 if s < self.grammar.base else int(self.grammar.lengths[s - self.grammar.base])
                    if at >= size:
                        at, s = at - size, int(self.grammar.right[rule])
                return s
            at -= size
        raise IndexError(at)

    def ids(self) -> np.ndarray:
        return expand(self.symbols, self.grammar)


def _body_size(head: tuple[int, ...]) -> int:
    docs, rules, symbols, _, planes = head
    return 25 * docs + 12 * rules + 8 + 2 * symbols + planes * -(-symbols // 8)


def heads(path: str) -> Iterator[tuple[int, tuple[int, ...]]]:
    """Where each shard's body begins, and its five numbers; bodies are not read."""
    fs, at = open_fs(path), 0
    with fs[0].open_input_file(fs[1]) as f:
        while at < f.size():
            raw = f.read_at(44, at)
            if raw[:4] != MAGIC:
                raise ValueError(f"{path} is damaged at byte {at}")
            head = struct.unpack("<5Q", raw[4:])
            yield at + 44, head
            at += 44 + _body_size(head)


def shards(path: str) -> Iterator[Shard]:
    fs = open_fs(path)
    with fs[0].open_input_file(fs[1]) as f:
        for at, head in heads(path):
            yield Shard(head, f.read_at(_body_size(head), at))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, shard_ids: int = 1 << 20) -> int:
    """Encode whole texts and write files whose names sort as the ids in them: part-00000.rpr and so on.

    ``end_id`` follows each text; a null text is an empty one; null ids come
    first; rows of the same id are in order of their texts' hashes. Returns
    the number of ids. A shard closes once it holds ``shard_ids`` ids, so
    memory follows that, or the longest document. An empty table leaves an
    empty folder.
    """
    make_folder(docs.sparkSession, folder)
    order = [F.col(id_col).asc_nulls_first(), F.xxhash64(text_col)]
    dealt = docs.select(id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, keys, ids, sizes, total, encode = None, [], [], [], 0, encoder(tokenizer).encode

        def close() -> None:
            nonlocal keys, ids, sizes, out
            out = out or AtomicFile(folder, f"part-{TaskContext.get().partitionId():05d}.rpr")
            out.write(_shard(keys, np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])))
            keys, ids, sizes = [], [], []

        for part in (p for b in batches for p in slices(b, text_col)):
            got, starts = encode(part.column(text_col), end_id)
            keys += part.column(id_col).to_pylist()
            ids.append(got)
            sizes.append(np.diff(starts))
            total += len(got)
            if sum(map(len, ids)) >= shard_ids:
                close()
        if keys:
            close()
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], ["n"])

    return dealt.mapInArrow(tidy(run), "n long").agg(F.sum("n")).first()[0] or 0


def read_token_files(spark: SparkSession, folder: str, id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """One row per document of the files: its id, start, n_tokens and ids_crc32, and with ``keep_ids`` the ids (array<int>)."""
    files = list_files(spark, folder).withColumn("file", F.regexp_extract("path", r"part-(\d+)\.rpr$", 1).cast("long")).select("path", "file")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [sum(h[3] for _, h in heads(p)) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(n, pa.int64())], ["file", "n"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, file in ((p, f) for b in batches for p, f in zip(b.column("path").to_pylist(), b.column("file").to_pylist())):
            before = 0
            for shard in shards(path):
                ids = np.ascontiguousarray(shard.ids(), "<u4")
                raw, at = memoryview(ids.view(np.uint8)), shard.starts
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                columns = [pa.array(shard.keys, pa.int64()), pa.array(np.full(len(crc), file), pa.int64()), pa.array(before + at[:-1]), pa.array(np.diff(at)), pa.array(crc, pa.int64())]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, [id_col, "file", "in_file", "n_tokens", "ids_crc32", *["ids"] * keep_ids])
                before += shard.n_ids

    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    ahead = files.mapInArrow(tidy(total), "file long, n long").select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    rows = files.mapInArrow(tidy(decode), f"`{id_col}` long, file long, in_file long, n_tokens long, ids_crc32 long" + ", ids array<int>" * keep_ids)
    out = rows.join(ahead, "file").withColumn("start", F.col("ahead") + F.col("in_file"))
    return out.select(id_col, "start", "n_tokens", "ids_crc32", *["ids"] * keep_ids)
