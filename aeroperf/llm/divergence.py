"""Source divergence audit: how far the sources of a language lie apart, and in which terms.

Systolic rotation. The vector of a group (a source within a language) stays in
the partition of its seat; compressed vectors of the other seats come by in the
rounds of a round-robin tournament, so that each pair of seats meets once, at
the seat of one of them, and a meeting gives the value of both directions. What
stays is decoded once, what travels is decoded, met and dropped, so a task holds
one seat and one visitor. Terms are dealt to shards of ``shard_terms`` at most;
each shard holds its own tournament, whose values add up. The heap of a seat
ranks its own terms against the language.

Sizes: a seat holds at most 64 groups, each of ``shard_terms`` 8-byte values;
there are at least ``seats`` seats where a language has so many groups. A vector
travels to half of the seats. All rounds run in one job: rows arrive at a seat
in the order of the rounds, and no seat waits for another.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroperf.llm.hashing import buffers, lowered, slices, span_hashes
from aeroperf.llm.runs import any_letter, spans, strings
from aeroperf.llm.storage import discard, stored
from aeroperf.llm.workers import tidy

_COUNTED = "lang string, source string, term string, n long, docs long"
_MET = "lang string, shard int, slot int, other int, idx int, value long"
_LANG, _HOME = -2, -1


@tidy
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term in each group of a slice. A term is known by its 64-bit hash within a slice."""
    for batch in batches:
        for part in slices(batch, "text", 1 << 23):
            data, offsets = buffers(part.column("text"))
            begin, end, bounds = spans(any_letter(data), offsets)
            if not len(begin):
                continue
            data = lowered(data)
            names: dict[tuple[str, str], int] = {}
            group = np.array([names.setdefault(x, len(names)) for x in zip(part.column("lang").to_pylist(), part.column("source").to_pylist())])
            _, first, term = np.unique(span_hashes(data, begin, end), return_index=True, return_inverse=True)
            doc = np.repeat(np.arange(len(part)), np.diff(bounds))
            held, times = np.unique(term * len(part) + doc, return_counts=True)  # a row for each term of each document
            key, back = np.unique(held // len(part) * len(names) + group[held % len(part)], return_inverse=True)
            n, docs = np.bincount(back, times).astype(np.int64), np.bincount(back)
            own = list(names)
            terms = strings(data, begin[first], end[first] - begin[first]).take(pa.array(key // len(names)))
            columns = [pa.array([x[i] for x in own]).take(pa.array(key % len(names))) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, terms, pa.array(n), pa.array(docs)], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, text), none null -> (lang, source, term, n, docs): occurrences, and documents that hold the term."""
    return docs.mapInArrow(_count, _COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def smoothed(count: Column, n: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (n + 5 terms)), exactly: long division in two steps, below 2^63 up to 9e13 occurrences; null without terms."""
    top, d = (count + 5) * 10_000, F.nullif(n + 5 * terms, F.lit(0))
    whole = lambda a, b: F.call_function("div", a, b)
    return whole(top, d) * 100_000 + whole(top % d * 100_000, d) + 1


def _compress(table: pa.Table) -> pa.Table:
    """The vector of one group in one shard: numbers of its terms and their values, in the order of the terms."""
    idx, p = table.column("idx").to_numpy(), table.column("p").to_numpy()
    order = np.argsort(idx)
    raw = np.diff(idx[order], prepend=0).astype("<u4").tobytes() + p[order].astype("<u4").tobytes()
    head = [table.column(c)[:1].combine_chunks() for c in ("lang", "shard", "slot")]
    return pa.table([*head, pa.array([len(idx)], pa.int32()), pa.array([pa.compress(raw, codec="zstd", asbytes=True)])], ["lang", "shard", "slot", "held", "vector"])


def _decode(vector: bytes | None, held: int | None, base: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(values of all terms of the shard, numbers of the terms that the group holds)."""
    out = np.full(width, base, np.int64)
    if not held:
        return out, np.zeros(0, np.int64)
    raw = np.frombuffer(pa.decompress(vector, decompressed_size=8 * held, codec="zstd", asbytes=True), "<u4").astype(np.int64)
    idx = np.cumsum(raw[:held])
    out[idx] = raw[held:]
    return out, idx


def _meetings(top: int):
    """Rows of a partition, by seat and round, to what the meetings at each seat give."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seat, homes, slots, reference = None, [], [], None
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                key = r["lang"], r["shard"], r["home"]
                if key != seat:
                    seat, homes, slots, reference = key, [], [], None
                values, idx = _decode(r["vector"], r["held"], r["base"], r["width"])
                if r["round"] == _LANG:
                    reference = values
                    continue
                met = [(s, int(np.abs(h - values).sum())) for s, h in zip(slots, homes)]
                out += [(*key[:2], a, b, None, v) for s, v in met for a, b in ((s, r["slot"]), (r["slot"], s))]
                if r["round"] == _HOME:
                    homes.append(values)
                    slots.append(r["slot"])
                    out += [(*key[:2], r["slot"], None, i, v) for v, i in _heap(values[idx] - reference[idx], idx, top)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["lang", "shard", "slot", "other", "idx", "value"])

    return run


def _heap(value: np.ndarray, idx: np.ndarray, top: int) -> list[tuple[int, int]]:
    """(value, number) of the ``top`` largest values above 0, equal ones by number, which follows the order of the terms."""
    least = max(1, int(np.partition(value, -top)[-top])) if len(value) > top else 1
    held = value >= least
    return [(-v, i) for v, i in heapq.nsmallest(top, zip((-value[held]).tolist(), idx[held].tolist()))]


def divergence(docs: DataFrame, min_docs: int = 30, top: int = 50, seats: int = 64, shard_terms: int = 1 << 15) -> DataFrame:
    """Part ``pair``: the sum of the differences of a group to every other source of its language; part ``term``: the ``top`` terms that a group holds more of than its language.

    ``docs``: text, lang, source; a null is ''. Further columns are not read, and
    rows that repeat count as often as they stand there. Terms: runs of letters
    and of characters beyond ASCII, A-Z lower-cased, in at least ``min_docs``
    documents of the language. A group without terms (no text, or none kept) has
    the smoothed value of a count of 0 throughout, and a language without kept
    terms has differences of 0. Equal values are ranked by item in the order of
    UTF-8. A text of any length is counted whole. An empty table gives no rows.
    Returns lang, source, part, item, value long, rank int.
    """
    empty = F.lit("")
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")])
    counts = stored(term_counts(texts), "term-counts")
    lang_terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    found = stored(lang_terms.select("lang", "term", "n"), "lang-terms")
    langs = found.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_n"), F.ceil(F.count("*") / shard_terms).cast("int").alias("shards"))
    place = F.row_number().over(Window.partitionBy("lang", "shard").orderBy("term")) - 1
    sharded = found.join(langs, "lang").withColumn("shard", F.pmod(F.xxhash64("term"), "shards").cast("int")).repartition("lang", "shard")
    kept = sharded.withColumn("idx", place)  # by shard: the join's partitions, a language each, would serve the window too
    kept = stored(kept.withColumn("p", smoothed(F.col("n"), F.col("lang_n"), F.col("terms"))).select("lang", "term", "shard", "idx", "p"), "kept-terms")
    held = stored(counts.join(kept, ["lang", "term"]).select("lang", "source", "shard", "idx", "n"), "kept-counts")
    discard(counts)

    sources = texts.select("lang", "source").distinct().join(held.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left").join(langs, "lang", "left")
    by_lang = Window.partitionBy("lang")
    groups = sources.na.fill(0, ["n", "terms"]).na.fill(1, ["shards"]).withColumns({"slot": F.row_number().over(by_lang.orderBy("source")) - 1, "_all": F.count("*").over(by_lang)})
    wide = F.least(F.lit(64), F.ceil(F.col("_all") / seats)).cast("int")
    groups = groups.withColumns({"seat": F.floor(F.col("slot") / wide).cast("int"), "seats": F.ceil(F.col("_all") / wide).cast("int"), "base": F.coalesce(smoothed(F.lit(0), F.col("n"), F.col("terms")), F.lit(0))})
    groups = stored(groups.select("lang", "source", "slot", "seat", "seats", "n", "terms", "shards", "base"), "groups")

    own = held.join(groups.select("lang", "source", "slot", F.col("n").alias("_n"), "terms"), ["lang", "source"])
    values = own.select("lang", "shard", "slot", "idx", smoothed(F.col("n"), F.col("_n"), F.col("terms")).alias("p")).unionByName(kept.select("lang", "shard", F.lit(_LANG).alias("slot"), "idx", "p"))
    vectors = stored(values.groupBy("lang", "shard", "slot").applyInArrow(_compress, "lang string, shard int, slot int, held int, vector binary"), "vectors")
    discard(held)
    met = stored(_rounds(groups, vectors, kept).mapInArrow(_meetings(top), _MET), "met")

    name = groups.select("lang", "slot", "source")
    pairs = met.where("other IS NOT NULL").groupBy("lang", "slot", "other").agg(F.sum("value").alias("value"))
    pairs = pairs.join(name, ["lang", "slot"]).join(name.toDF("lang", "other", "item"), ["lang", "other"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    best = met.where("idx IS NOT NULL").join(kept.select("lang", "shard", "idx", F.col("term").alias("item")), ["lang", "shard", "idx"])
    best = best.join(name, ["lang", "slot"]).select("lang", "source", F.lit("term").alias("part"), "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return pairs.select("*", rank).unionByName(best.select("*", rank).where(F.col("rank") <= top))


def _rounds(groups: DataFrame, vectors: DataFrame, kept: DataFrame) -> DataFrame:
    """Every vector at every seat it comes to, by round: first the language's own, then those that stay, then the visitors.

    Of seats i < j, the lower is at home where j - i is odd, so each is at home
    half of the time; they meet in round (i + j) mod (seats - 1), or, where j is
    the last of an even number, in round 2 i mod (seats - 1): the circle method.
    """
    width = kept.groupBy("lang", "shard").agg(F.count("*").cast("int").alias("width"))
    frame = groups.select("lang", "slot", "seat", "seats", "base", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    frame = frame.join(vectors, ["lang", "shard", "slot"], "left").join(width, ["lang", "shard"], "left").na.fill(0, ["width", "held"])
    columns = ["lang", "shard", "home", "round", "slot", "base", "width", "held", "vector"]
    staying = frame.withColumns({"home": F.col("seat"), "round": F.lit(_HOME)})
    hosts = F.expr("filter(sequence(0, seats - 1), h -> h <> seat AND abs(h - seat) % 2 = if(h < seat, 1, 0))")
    low, high, turns = F.least("home", "seat"), F.greatest("home", "seat"), F.col("seats") + F.col("seats") % 2 - 1
    travelling = frame.withColumn("home", F.explode(hosts)).withColumn("round", F.when(high == turns, 2 * low).otherwise(low + high) % turns)
    seats = groups.select("lang", F.col("seat").alias("home"), "shards").distinct()
    reference = seats.select("lang", "home", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    reference = reference.join(vectors.where(F.col("slot") == _LANG), ["lang", "shard"], "left").join(width, ["lang", "shard"], "left")
    reference = reference.na.fill(0, ["width", "held"]).withColumns({"slot": F.lit(_LANG), "round": F.lit(_LANG), "base": F.lit(0).cast("long")})
    rows = staying.select(columns).unionByName(travelling.select(columns)).unionByName(reference.select(columns))
    return rows.repartition("lang", "shard", "home").sortWithinPartitions("lang", "shard", "home", "round", "slot")
