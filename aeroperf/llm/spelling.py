"""Spelling variants: words that differ by one inserted, deleted or replaced code point, grouped under the most frequent spelling.

Aho-Corasick halves. Of two words at distance 1, the edit lies in one half of
the first, so its other half stands unchanged in the second: the left one at
its beginning, or the right one at its end. Automaton shards hold both halves of
every word; every word is scanned by the shards that can hold a half that it
begins or ends with (six keys at most: two sides, three lengths), and what the
automaton finds at the right offset, in words of a compatible length, is
verified. A pair counts where its edit stands, at the end of the words' common
beginning, so it is found once from each side.

A half that many words share ("inter") would meet all of them with all: beyond
``most`` words, its unknown part is halved again, and the word is held under two
keys that leave a quarter unknown each, and so on. At a part of one character
no more words than characters share a key, so every key ends up small, without
a cap on words or pairs.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroperf.llm.hashing import buffers, lowered, slices, span_hashes
from aeroperf.llm.runs import latin_letter, spans, strings
from aeroperf.llm.storage import discard, stored
from aeroperf.llm.workers import tidy

#: Runs of at most so many bytes are hashed side by side, longer ones one by one.
_SHORT = 64


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc32_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray, state: np.ndarray) -> np.ndarray:
    """crc32 of each span as it goes on from ``state``, the crc32 of what stands before."""
    out, size = ~state.astype(np.uint32), end - begin
    order = np.argsort(size, kind="stable")
    sizes = size[order]
    for k in range(int(min(sizes[-1], _SHORT)) if len(sizes) else 0):
        some = order[np.searchsorted(sizes, k, "right") : np.searchsorted(sizes, _SHORT, "right")]
        out[some] = _CRC[(out[some] ^ data[begin[some] + k]) & 0xFF] ^ (out[some] >> np.uint32(8))
    out = ~out
    for i in order[np.searchsorted(sizes, _SHORT, "right") :].tolist():
        out[i] = zlib.crc32(data[begin[i] : end[i]].tobytes(), int(state[i]))
    return out


def _words(every: int, shortest: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 23):
                data, offsets = buffers(part.column("text"))
                begin, end, bounds = spans(latin_letter(data), offsets)
                data = lowered(data)
                points = np.zeros(len(data) + 1, np.int64)
                np.cumsum((data & 0xC0) != 0x80, out=points[1:])
                length = points[end] - points[begin]
                heads = np.array([zlib.crc32(f"{'' if x is None else x}:".encode()) for x in part.column("doc_id").to_pylist()], np.uint32)
                doc = np.repeat(np.arange(len(part)), np.diff(bounds))
                held = length >= shortest  # no word gets longer
                begin, end, length, doc = begin[held], end[held], length[held], doc[held]
                h = crc32_spans(data, begin, end, heads[doc])
                cut = h % every == 0
                found = _without(data, points, begin[cut], end[cut], h[cut] % length[cut], shortest)
                begin, end = begin[~cut], end[~cut]
                if len(begin):
                    _, first, n = np.unique(span_hashes(data, begin, end), return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays([strings(data, begin[first], end[first] - begin[first]), pa.array(n)], ["word", "n"])
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.ones(len(found), np.int64))], ["word", "n"])

    return run


def _without(data: np.ndarray, points: np.ndarray, begin: np.ndarray, end: np.ndarray, place: np.ndarray, shortest: int) -> list[str]:
    """The runs without the code point at their place, those that stay long enough."""
    out = []
    for a, b, i in zip(begin.tolist(), end.tolist(), place.tolist()):
        run = data[a:b].tobytes().decode()
        if len(run) > shortest:
            out.append(run[:i] + run[i + 1 :])
    return out


def word_counts(docs: DataFrame, every: int = 199, shortest: int = 6, least: int = 5) -> DataFrame:
    """(doc_id, text) -> (word, n): runs ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts, A-Z lower-cased, of ``shortest`` code points and ``least`` occurrences.

    Where ``every`` divides the crc32 of ``<doc_id>:<run>``, the run loses the
    code point at that crc32 modulo its length. A null id is empty there.
    """
    counted = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(_words(every, shortest), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


#: A key: what is known of a word of m code points but for its places lo to hi.
_KEY = ["m", "lo", "hi", "pre", "suf"]


def _owners(words: DataFrame) -> DataFrame:
    """Each word under its two halves: the edit is in the other one."""
    m = F.length("word")
    half = F.floor(m / 2).cast("int")
    parts = F.array(F.struct(half.alias("lo"), m.alias("hi")), F.struct(F.lit(0).alias("lo"), half.alias("hi")))
    return _keyed(words.select("word", "n", m.alias("m"), F.explode(parts).alias("_p")).select("word", "n", "m", "_p.lo", "_p.hi"))


def _scanned(words: DataFrame) -> DataFrame:
    """Each word under the keys of the words that it may be near to: theirs may be one longer, as long, or one shorter."""
    l = F.length("word")  # noqa: E741
    half = F.floor(F.col("m") / 2).cast("int")
    parts = F.array(F.struct(half.alias("lo"), F.col("m").alias("hi")), F.struct(F.lit(0).alias("lo"), half.alias("hi")))
    return _keyed(words.select("word", F.explode(F.array(l - 1, l, l + 1)).alias("m")).select("word", "m", F.explode(parts).alias("_p")).select("word", "m", "_p.lo", "_p.hi"))


def _keyed(rows: DataFrame) -> DataFrame:
    """With the key of the unchanged parts; a word too short for them has none."""
    tail = F.col("m") - F.col("hi")
    pre, suf = F.expr("substring(word, 1, lo)"), F.expr("right(word, m - hi)")
    known = rows.where(F.length("word") >= F.col("lo") + tail).withColumns({"_pre": pre, "_suf": F.when(tail > 0, suf).otherwise("")})
    return known.withColumn("key", F.xxhash64("m", "lo", "hi", "_pre", "_suf")).drop("_pre", "_suf")


def _halved(rows: DataFrame) -> DataFrame:
    """The same words, under two keys that each leave half of the unknown part unknown."""
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    parts = F.array(F.struct("lo", mid.alias("hi")), F.struct(mid.alias("lo"), "hi"))
    rest = [c for c in rows.columns if c not in ("lo", "hi", "key")]
    return _keyed(rows.withColumn("_p", F.explode(parts)).select(*rest, "_p.lo", "_p.hi"))


def _dealt(words: DataFrame, most: int) -> DataFrame:
    """(key, m, lo, hi, word, n) of owners, and of scanned words with n null, under keys of ``most`` owners at most."""
    owners, scans, out = _owners(words), _scanned(words), None
    while True:
        held = stored(owners, "owners")
        crowded = held.where("hi - lo > 1").groupBy("key").count().where(F.col("count") > most).select("key")
        crowded = stored(crowded, "crowded-keys")
        if crowded.isEmpty():
            level = held.unionByName(scans.withColumn("n", F.lit(None).cast("long")))
            return level if out is None else out.unionByName(level)
        scanned = stored(scans, "scanned-words")
        level = held.join(crowded, "key", "left_anti").unionByName(scanned.join(crowded, "key", "left_anti").withColumn("n", F.lit(None).cast("long")))
        out = level if out is None else out.unionByName(level)
        owners, scans = _halved(held.join(crowded, "key", "left_semi")), _halved(scanned.join(crowded, "key", "left_semi"))


def near(owners: np.ndarray, scanned: np.ndarray, m: int, lo: int, hi: int) -> np.ndarray:
    """Which owners (rows of m bytes) lie at distance 1 of which scanned words (rows of equal width), the edit being between lo and hi.

    What stands outside of lo and hi is the same. The edit is where the common
    beginning ends; an edit found beyond hi belongs to another key.
    """
    width = scanned.shape[1]
    a, last = owners[None, :, lo:hi], hi == m
    ahead = np.logical_and.accumulate(a[:, :, : width - lo] == scanned[:, None, lo : min(hi, width)], axis=2)
    same = ahead.sum(axis=2, dtype=np.int32)
    if width == m:
        return (a != scanned[:, None, lo:hi]).sum(axis=2, dtype=np.int32) == 1
    if width == m - 1:  # the owner has a code point more, at lo + same
        behind = np.logical_and.accumulate((a[:, :, 1:] == scanned[:, None, lo : hi - 1])[:, :, ::-1], axis=2).sum(axis=2, dtype=np.int32)
        return (same < hi - lo) & (same + behind >= hi - lo - 1)
    behind = np.logical_and.accumulate((a == scanned[:, None, lo + 1 : hi + 1])[:, :, ::-1], axis=2).sum(axis=2, dtype=np.int32)
    return (same + behind >= hi - lo) & ((same < hi - lo) | last)


def _matrix(words: list[str]) -> np.ndarray:
    """The code points of words of equal length, a row each, in bytes where they fit."""
    text = "".join(words)
    points = np.frombuffer(text.encode("latin-1"), np.uint8) if max(text) <= "\xff" else np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return points.reshape(len(words), -1)


class _Automaton:
    """The words of a shard under their keys, in an Aho-Corasick automaton of the keys' longer unchanged part."""

    def __init__(self, rows: list[tuple[str, int, int, int, int]]):
        """rows: (word, n, m, lo, hi)."""
        import ahocorasick

        keys: dict[tuple, list[tuple[int, str]]] = defaultdict(list)
        for word, n, m, lo, hi in rows:
            keys[m, lo, hi, word[:lo], word[hi:]].append((-n, word))
        self.keys, self.owners, self.machine = list(keys), [sorted(x) for x in keys.values()], ahocorasick.Automaton()
        segments: dict[str, list[int]] = defaultdict(list)
        for i, (_, _, _, pre, suf) in enumerate(self.keys):
            segments[pre if len(pre) >= len(suf) else suf].append(i)
        for segment, held in segments.items():
            self.machine.add_word(segment, (len(segment), held))
        self.machine.make_automaton()

    def found(self, word: str) -> Iterator[int]:
        """Keys whose unchanged parts stand at the beginning and the end of the word, for words of a compatible length."""
        size = len(word)
        for end, (length, held) in self.machine.iter(word):
            if end + 1 != length and end + 1 != size:  # neither at the beginning nor at the end
                continue
            for i in held:
                m, lo, hi, pre, suf = self.keys[i]
                if abs(m - size) <= 1 and size >= lo + m - hi:
                    first = len(pre) >= len(suf)
                    if (end + 1 == length and word.endswith(suf)) if first else (end + 1 == size and word.startswith(pre)):
                        yield i

    def meet(self, words: list[str]) -> Iterator[tuple[str, int, int, str]]:
        """(word, near words under a key, n of the most frequent of them, that word)."""
        met: dict[int, list[str]] = defaultdict(list)
        for word in words:
            for i in self.found(word):
                met[i].append(word)
        for i, scanned in met.items():
            own = self.owners[i]
            if len(own) == 1 and scanned == [own[0][1]]:
                continue
            m, lo, hi, _, _ = self.keys[i]
            left = _matrix([w for _, w in own])
            step = max(1, (1 << 22) // (len(own) * m))
            for width in (m - 1, m, m + 1):
                some = [w for w in scanned if len(w) == width]
                for j in range(0, len(some), step):
                    tile = some[j : j + step]
                    hits = near(left, _matrix(tile), m, lo, hi)
                    n, best = hits.sum(axis=1), hits.argmax(axis=1)
                    for k in np.flatnonzero(n).tolist():
                        yield tile[k], int(n[k]), -own[best[k]][0], own[best[k]][1]


@tidy
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by shard, owners before scanned words: an automaton at a time, words in batches."""
    shard, rows, machine, last = None, [], None, None
    for batch in batches:
        if not len(batch):
            continue
        own = batch.column("shard").to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
        for a, b in zip(edges, edges[1:]):
            part = batch.slice(a, b - a)
            if own[a] != shard:
                shard, rows, machine, last = own[a], [], None, None
            is_owner = part.column("n").is_valid()
            held = part.filter(is_owner)
            rows += zip(*(held.column(c).to_pylist() for c in ("word", "n", "m", "lo", "hi")))
            words = part.filter(pc.invert(is_owner)).column("word").to_pylist()
            if not words:
                continue
            machine, rows = machine or (_Automaton(rows) if rows else None), []
            words, last = [w for w, before in zip(words, [last, *words]) if w != before], words[-1]  # a word comes once to a shard
            out = list(machine.meet(words)) if machine else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, most: int = 4096, shard_words: int = 1 << 15) -> DataFrame:
    """(word, n) -> (word, n_near, best_n, best) of every word that has near words: how many, and that of the largest n (ties: smallest in code-point order)."""
    dealt = _dealt(words, most)
    shards = max(1, -(-2 * words.count() // shard_words))
    rows = dealt.select("word", "n", "m", "lo", "hi", F.pmod("key", F.lit(shards)).cast("int").alias("shard"))
    rows = rows.repartition("shard").sortWithinPartitions("shard", F.col("n").isNull(), "word")
    met = rows.mapInArrow(_scan, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b")).select("word", "n_near", (-F.col("_b.n")).alias("best_n"), F.col("_b.word").alias("best"))


def variants(words: DataFrame, factor: int = 5, most: int = 4096, shard_words: int = 1 << 15) -> DataFrame:
    """(word, n) -> (word, n, form, root, n_near, form_n) for every word.

    ``words``: distinct words with their counts; further columns are not read,
    null words and counts take no part, and a word of one code point or none is
    near to nothing. ``form``: the near word of the
    largest n, if that is at least ``factor`` (2 or more) times the word's; else
    null. ``root``: the end of the chain of forms; counts grow along it, so it
    ends. An empty table gives no rows.
    """
    own = stored(words.select("word", F.col("n").cast("long").alias("n")).where("word IS NOT NULL AND n IS NOT NULL"), "words")
    found = near_words(own.where(F.length("word") > 1), most, shard_words)
    formed = F.col("best_n") >= factor * F.col("n")
    out = own.join(found, "word", "left").select("word", "n", F.when(formed, F.col("best")).alias("form"), F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best_n")).alias("form_n"))
    out = stored(out, "forms")
    up = out.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # a round doubles the steps of the chain that are taken
        up = stored(up, "roots")
        above = up.select(F.col("word").alias("root"), F.col("root").alias("above"))
        if up.join(above, "root", "left_semi").isEmpty():
            break
        longer = up.join(above, "root", "left").select("word", F.coalesce("above", "root").alias("root"))
        up = longer
    return out.join(up, "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")


def spelling_variants(docs: DataFrame, every: int = 199, shortest: int = 6, least: int = 5, factor: int = 5) -> DataFrame:
    """``variants`` of the words of ``docs`` (doc_id, text), as ``word_counts`` takes them.

    Null and empty texts have no words, texts of any length are read whole, rows
    that repeat count each time, and further columns are not read.
    """
    words = stored(word_counts(docs, every, shortest, least), "word-counts")
    out = variants(words, factor)
    discard(words)
    return out
