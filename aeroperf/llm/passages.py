"""Substring dedup: paragraphs by content, MinHash banding, exact Jaccard, components.

A paragraph is a line, or a block between blank lines, of ``size`` words or
more. Where a line is longer than a ``wide`` window can miss, such windows, which
begin at content anchors, are paragraphs as well. Each paragraph's 5-word
shingles are MinHashed into bands. Paragraphs that collide in a band are either
equal in content (the common case, settled by their hashes) or candidates: all
pairs of a key's contents are looked at, those of a large key in salted tiles,
and a pair counts if the exact Jaccard of its shingles, taken from the texts,
reaches the threshold. Only pairs that are linked already are skipped. Keys with
the same contents are one group.

Passages repeat in the middle of lines as well. So windows of ``size`` words at
anchors (the least 5-word hash of ``gap`` consecutive starts) take part by their
content alone: any run of ``size + gap - 1`` words that two documents share (51
by default: over 50 words) holds an anchor and its whole window in both. One
changed word touches five of its 28 shingles, so bands would tell little more.

Equal contents, and verified pairs by their connected components, form clusters.
The document of the smallest id keeps a cluster's passage, all others lose it:
from the first word to the last that stand alike around it in the keeper's text.

Only narrow rows are shuffled. Equal contents in one slice of a task send one
row between them, the smallest id's: the others lose the passage whoever keeps
it in the end. So one that a third of all documents hold makes no hot group, and
only documents that keep an exact class take part in what follows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from aeroperf.llm.components import components
from aeroperf.llm.hashing import _powers, buffers, mix, runs, slices, words
from aeroperf.llm.id_filter import IdFilter
from aeroperf.llm.jaccard import tile_links
from aeroperf.llm.storage import release, stored
from aeroperf.llm.workers import tidy

U = np.uint64
FIRST, KEY, LOST, ECHO, MEMBER = 0, 1, 2, 3, 4  # a paragraph under its first key; in another; lost to a smaller id; repeated within a document; one of several contents of a key
SHINGLE = 5
TURNS = 3  # groups are compared by turns: the sets of all at once would take more disk than the corpus


def tune_bands(threshold: float, rows: int, recall: float) -> int:
    """Bands of ``rows`` MinHashes under which a pair at the threshold collides with probability ``recall`` or more."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


def anchors(grams: np.ndarray, first: np.ndarray, count: np.ndarray, gap: int) -> np.ndarray:
    """Places of the least gram among every ``gap`` consecutive starts; ``first`` and ``count`` give each document's starts."""
    n, low = len(grams), U((1 << 20) - 1)
    packed = (grams & ~low) | (np.arange(n, dtype=np.uint64) & low)
    least, width = packed, 1
    while 2 * width <= gap:
        least, width = np.minimum(least[:-width], least[width:]) if len(least) > width else least[:0], 2 * width
    if width < gap and len(least):
        least = np.minimum(least[: max(0, len(least) - (gap - width))], least[gap - width :])
    at = []
    long = count >= gap
    if long.any():
        whole = count[long] - gap + 1
        i = np.repeat(first[long] - (np.cumsum(whole) - whole), whole) + np.arange(whole.sum())
        at.append(i + ((least[i] - i.astype(np.uint64)) & low).astype(np.int64))
    short = (count > 0) & ~long
    for a, c in zip(first[short].tolist(), count[short].tolist()):
        at.append(np.array([a + int(packed[a : a + c].argmin())]))
    if not at:
        return np.zeros(0, np.int64)
    at = np.unique(np.concatenate(at))
    same = np.r_[False, (at[1:] == at[:-1] + 1) & (grams[at[1:]] == grams[at[:-1]])]  # one word over and over
    begins = np.flatnonzero(~same)
    place = np.arange(len(at)) - np.repeat(begins, np.diff(np.r_[begins, len(at)]))
    return at[place % max(1, gap - 4) == 0]


def blocks(texts: pa.Array, bounds: np.ndarray, begin: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word among all words, number of words) of ``least`` or more: of each line, and of each line and each block between blank lines."""
    data, offsets = buffers(texts)
    line = np.r_[0, np.cumsum(data == 10)][begin + np.repeat(offsets[:-1], np.diff(bounds))]
    step = np.diff(line, prepend=0)
    step[bounds[:-1][np.diff(bounds) > 0]] = 2
    found = []
    for least_step in (1, 2):
        at = np.flatnonzero(step >= least_step)
        found.append(np.stack([at, np.diff(np.r_[at, len(begin)])], 1))
    lines, both = found[0], np.unique(np.concatenate(found), axis=0)
    return lines[lines[:, 1] >= least], both[both[:, 1] >= least]


def paragraphs(texts: pa.Array, size: int, gap: int, wide: int, short: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word in it, words, content hash, place among all words, whether it is banded) of each paragraph and window, and all grams last."""
    h, bounds, begin, _ = words(texts)
    count = np.maximum(np.diff(bounds) - size + 1, 0)
    grams = runs(h, SHINGLE)
    windows = anchors(grams, bounds[:-1], count, gap)
    lines, (at, n) = (x.T for x in blocks(texts, bounds, begin, size))
    step = 2 * wide // 3
    long = lines[1] >= wide + step
    inner = anchors(grams, lines[0][long], lines[1][long] - wide + 1, step)
    few = blocks(texts, bounds, begin, short)[1] if short else np.zeros((0, 2), np.int64)
    few = few[few[:, 1] < size]
    alone = len(windows) + len(few)  # these take part by their content alone
    n = np.r_[np.full(len(windows), size), few[:, 1], n, np.full(len(inner), wide)]
    at, whole = np.r_[windows, few[:, 0], at, inner], np.r_[np.zeros(alone, bool), np.ones(len(n) - alone, bool)]
    doc = np.searchsorted(bounds, at, "right") - 1
    powers, inverses = _powers(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h ^ U(0xC0FFEE)) * powers[: len(h)], out=total[1:])
    content = mix((total[at + n] - total[at]) * inverses[at] + whole * n.astype(np.uint64))
    return doc, at - bounds[doc], n, content, at, whole, grams


def _emit(key, c, d, p, n, kind: int | np.ndarray, d2=None, p2=None, single=None) -> pa.RecordBatch:
    none = pa.nulls(len(c), pa.int64())
    other = [none if x is None else pa.array(x, pa.int64()) for x in (d2, p2)]
    columns = [pa.array(c), pa.array(d), pa.array(p, pa.int64()), pa.array(n, pa.int64()), pa.array(np.full(len(c), kind), pa.int8()), *other]
    names = ["c", "d", "p", "n", "kind", "d2", "p2"]
    if key is not None:
        return pa.RecordBatch.from_arrays([pa.array(key), *columns], ["key", *names])
    return pa.RecordBatch.from_arrays([*columns, pa.nulls(len(c), pa.bool_()) if single is None else pa.array(single)], [*names, "single"])


def _banded(size: int, gap: int, wide: int, bands: int, rows: int, short: int = 0):
    seeds = mix(np.arange(1, bands * rows + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in slices(b, "text")):
            part = part.filter(part.column("id").is_valid())
            ids = part.column("id").to_numpy()
            doc, place, n, content, at, whole, grams = paragraphs(part.column("text"), size, gap, wide, short)
            if not len(at):
                continue
            d = ids[doc]
            order = np.lexsort((place, d, content))
            d, place, n, content, at, whole = d[order], place[order], n[order], content[order], at[order], whole[order]
            first = np.r_[True, content[1:] != content[:-1]]
            lead = np.flatnonzero(first)
            of = np.repeat(lead, np.diff(np.r_[lead, len(at)]))
            c, leader = content.view(np.int64), d[of]
            for kind, rest in ((LOST, np.flatnonzero(~first & (d != leader))), (ECHO, np.flatnonzero(~first & (d == leader)))):
                if len(rest):
                    yield _emit(mix(content[rest] + rest.astype(np.uint64)).view(np.int64), c[rest], d[rest], place[rest], n[rest], kind, leader[rest], place[of[rest]])
            one = lead[~whole[lead]]
            yield _emit(mix(content[one] ^ U(size)).view(np.int64), c[one], d[one], place[one], n[one], FIRST)
            lead = lead[whole[lead]]
            held = n[lead] - SHINGLE + 1
            starts = np.cumsum(held) - held
            flat = grams[np.repeat(at[lead] - starts, held) + np.arange(held.sum())]
            for band in range(bands if len(lead) else 0):
                key = np.full(len(lead), (1 << 32) + band + 1, np.uint64)
                for seed in seeds[band * rows : (band + 1) * rows]:
                    key = mix(key + np.minimum.reduceat(mix(flat ^ seed), starts))
                yield _emit(key.view(np.int64), c[lead], d[lead], place[lead], n[lead], KEY if band else FIRST)

    return run


def _collide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paragraphs lost to a smaller id, and the contents of each key that has several (d2 names the group)."""
    got = []
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        done = kind >= LOST
        if done.any():
            b = batch.filter(pa.array(done))
            yield _emit(None, b.column("c"), b.column("d"), b.column("p"), b.column("n"), kind[done], b.column("d2"), b.column("p2"))
        b = batch.filter(pa.array(~done))
        got.append([b.column(x).to_numpy() for x in ("key", "c", "d", "p", "n", "kind")])
    if not got or not sum(len(x[0]) for x in got):
        return
    key, c, d, p, n, kind = (np.concatenate(x) for x in zip(*got))
    del got
    order = np.lexsort((p, d, c, key))
    key, c, d, p, n, kind = key[order], c[order], d[order], p[order], n[order], kind[order]
    new_key = np.r_[True, key[1:] != key[:-1]]
    new_c = new_key | np.r_[True, c[1:] != c[:-1]]
    begin = np.flatnonzero(new_c)
    count = np.diff(np.r_[begin, len(key)])
    holder = np.repeat(begin, count)
    lost = (kind == FIRST) & (d != d[holder])
    if lost.any():
        yield _emit(None, c[lost], d[lost], p[lost], n[lost], LOST, d[holder[lost]], p[holder[lost]])
    # one row for each (key, content), that of the smallest id
    of = np.flatnonzero(new_key[begin])
    group = np.cumsum(new_key[begin]) - 1
    # neighbouring paragraphs of one document overlap; what one document repeats doesn't count
    single, owner = count == 1, d[begin]
    apart = np.logical_or.reduceat(~single | (owner != owner[of][group]), of)
    several = ((np.diff(np.r_[of, len(begin)]) > 1) & apart)[group]
    # a group is named by its contents, so that those that meet in several bands are looked at once
    name = mix(np.add.reduceat(mix(c[begin].view(np.uint64)), of)).view(np.int64)[group]
    begin, name, single = begin[several], name[several], single[several]
    for at in range(0, len(begin), 50_000):
        i = begin[at : at + 50_000]
        yield _emit(None, c[i], d[i], p[i], n[i], MEMBER, name[at : at + 50_000], single=single[at : at + 50_000])


def group_links(group: np.ndarray, sets: list[np.ndarray], owner: np.ndarray, side: np.ndarray | None, num: int, den: int) -> list[tuple[int, int]]:
    """Links (i, j) with similarity >= num/den within each group (or between its two sides) that connect whatever such pairs connect.

    Rows of one ``owner`` are not paired.
    """
    order = np.argsort(group, kind="stable")
    cuts = np.split(order, np.flatnonzero(np.diff(group[order])) + 1)
    out, left, right = [], [], []
    for at in cuts:
        if side is None and len(at) <= 32:
            i, j = np.triu_indices(len(at), 1)
            left.append(at[i])
            right.append(at[j])
        else:
            found = tile_links([sets[x] for x in at], None if side is None else side[at], num, den, owner[at])
            out += [(int(at[i]), int(at[j])) for i, j in found]
    if not left:
        return out
    i, j = np.concatenate(left), np.concatenate(right)
    n = np.array([len(x) for x in sets])
    may = (owner[i] != owner[j]) & (n[i] * den >= num * n[j]) & (n[j] * den >= num * n[i])
    i, j = i[may], j[may]
    flat, starts = np.concatenate(sets), np.r_[0, np.cumsum(n)]
    ends = np.searchsorted(np.cumsum(n[i] + n[j]), np.arange(1 << 21, (n[i] + n[j]).sum() + (1 << 21), 1 << 21), "right")
    for x, y in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist()) if len(i) else ():
        both = np.concatenate([i[x:y], j[x:y]])
        size = n[both]
        index = np.repeat(starts[both] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        pair = np.repeat(np.tile(np.arange(len(both) // 2), 2), size)
        by = np.lexsort((flat[index], pair))
        value, pair = flat[index][by], pair[by]
        common = np.bincount(pair[1:][(value[1:] == value[:-1]) & (pair[1:] == pair[:-1])], minlength=len(both) // 2)
        hit = np.flatnonzero(common * (num + den) >= num * size.reshape(2, -1).sum(0))
        out += zip(both[hit].tolist(), both[len(both) // 2 + hit].tolist())
    return out


def _tile(num: int, den: int):
    def run(table: pa.Table) -> pa.Table:
        c, d, g, single, side = (table.column(x).to_numpy() for x in ("c", "d", "g", "single", "side"))
        _, owner = np.unique(d, return_inverse=True)
        owner = np.where(single, owner, len(owner) + np.arange(len(owner)))
        flat = table.column("shingles").combine_chunks()
        flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
        starts, values = flat.offsets.to_numpy(), flat.values.to_numpy().view(np.uint64)
        sets = [values[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
        links = group_links(g, sets, owner, side if table.column("cross")[0].as_py() else None, num, den)
        i, j = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(c[i]), "b": pa.array(c[j])})

    return run


def _shingles_at():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in slices(b, "text")):
            h, bounds, _, _ = words(part.column("text"))
            grams = runs(h, SHINGLE)
            wanted = part.column("wanted")
            row = np.repeat(np.arange(len(part)), np.diff(wanted.offsets.to_numpy()))
            flat = wanted.flatten()
            c, p, n = flat.field("c"), flat.field("p").to_numpy(), flat.field("n").to_numpy()
            sets = [np.unique(grams[a : a + m - SHINGLE + 1]).view(np.int64) for a, m in zip((bounds[row] + p).tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays([c, pa.array(sets, pa.list_(pa.int64()))], ["c", "shingles"])

    return run


def _verified(members: DataFrame, sets: DataFrame, threshold: float, tile: int) -> DataFrame:
    """Links (a, b) of contents that share a group. A group of more than ``tile`` contents, or of ``tile * 512`` words, is cut by hash, and all its tiles meet."""
    part = Fraction(threshold).limit_denominator(1000)
    large = stored(members.groupBy("g").agg(F.greatest(F.ceil(F.count("*") / tile), F.ceil(F.sum("n") / (tile * 512))).cast("int").alias("tiles")).where("tiles > 1"), "large-groups")
    total = members.agg(F.count("*").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    rooms = max(1, total["rows"] // 2048, total["words"] // (1 << 18))
    own = F.pmod(F.xxhash64(F.lit(3), "c"), F.col("tiles")).cast("int")
    dealt = members.join(large, "g", "left").withColumn("own", own).join(sets, "c")
    other = lambda o: F.struct(F.least("own", o).alias("t1"), F.greatest("own", o).alias("t2"), (F.col("own") > o).cast("int").alias("side"), (F.col("own") != o).alias("cross"))
    alone = F.array(F.struct(F.lit(-1).alias("t1"), F.lit(-1).alias("t2"), F.lit(0).alias("side"), F.lit(False).alias("cross")))
    where = F.when(F.col("tiles").isNull(), alone).otherwise(F.transform(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1), other))
    room = F.when(F.col("tiles").isNull(), F.pmod(F.xxhash64("g"), F.lit(rooms))).otherwise(F.col("g"))
    dealt = dealt.select(room.alias("room"), "g", "c", "d", "single", "shingles", F.explode(where).alias("m")).select("room", "g", "c", "d", "single", "shingles", "m.*")
    links = None
    for turn in range(TURNS):  # sets go with every group they are in: by turns, that the shuffles of one go before the next
        some = dealt.where(F.pmod(F.xxhash64(F.lit(5), "g"), F.lit(TURNS)) == turn).groupBy("room", "t1", "t2")
        some = stored(some.applyInArrow(_tile(part.numerator, part.denominator), "a long, b long"), "links")
        links = some if links is None else links.union(some)
        release(members.sparkSession)
    return links


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 32, gap: int = 20, wide: int = 96, threshold: float = 0.8, rows: int = 3, recall: float = 0.99, tile: int = 1024, short: int = 0) -> DataFrame:
    """Spans to remove: id, start (in words, from 0), n_words, found_in (a smaller id that holds the passage).

    Within a cluster the smallest id keeps the passage. A null text is an empty
    one; null ids take no part. Only passages that different ids hold count:
    what one document repeats is left alone, unless another keeps it. A
    document shorter than ``size`` words has no paragraph, unless ``short`` is
    set: lines and blocks of ``short`` to ``size - 1`` words (headers, footers,
    notices) then go as well where another document holds the same words.
    Repeated rows of one
    id are one document. Overlapping paragraphs are merged into one span, and spans reach to the ends of the run of words that the keeper shares. An
    empty table gives no row.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    dealt = base.mapInArrow(tidy(_banded(size, gap, wide, tune_bands(threshold, rows, recall), rows, short)), "key long, c long, d long, p long, n long, kind byte, d2 long, p2 long").repartition("key")
    met = stored(dealt.mapInArrow(tidy(_collide), "c long, d long, p long, n long, kind byte, d2 long, p2 long, single boolean"), "paragraphs")
    del dealt
    release(base.sparkSession)
    exact = met.where(F.col("kind") == LOST).select("c", "d", "p", "n", F.col("d2").alias("found_in"), "p2", F.col("n").alias("n2"))

    members = met.where(F.col("kind") == MEMBER).groupBy(F.col("d2").alias("g"), "c", "n").agg(F.min(F.struct("d", "p")).alias("at"), F.min("single").alias("single"))
    members = stored(members.select("g", "c", "n", "at.d", "at.p", "single"), "members")
    places = stored(members.groupBy("c", "n").agg(F.min(F.struct("d", "p")).alias("at")).select("c", "n", "at.d", "at.p"), "places")
    wanted = places.groupBy("d").agg(F.collect_list(F.struct("c", "p", "n")).alias("wanted"))
    texts = IdFilter(places.select("d")).hits(base, "id").join(wanted, F.col("id") == F.col("d")).select("text", "wanted")
    sets = stored(texts.mapInArrow(tidy(_shingles_at()), "c long, shingles array<long>").dropDuplicates(["c"]), "shingles")
    links = _verified(members, sets, threshold, tile)
    near = stored(places.join(components(links).withColumnRenamed("node", "c"), "c"), "near-classes")
    keepers = near.groupBy("component").agg(F.min(F.struct("d", "p", "n")).alias("k")).select("component", F.col("k.d").alias("found_in"), F.col("k.p").alias("p2"), F.col("k.n").alias("n2"))
    near = near.join(keepers, "component").where("d <> found_in").select("c", "d", "p", "n", "found_in", "p2", "n2")
    lost = stored(exact.withColumn("near", F.lit(False)).unionByName(near.withColumn("near", F.lit(True))), "lost")
    kept = lost.groupBy("c", "d").agg(F.min(F.struct("found_in", "p2", "n2")).alias("k"))
    echoes = met.where(F.col("kind") == ECHO).select("c", "d", "p", "n").join(kept, ["c", "d"]).select("c", "d", "p", "n", "k.found_in", "k.p2", "k.n2", F.lit(False).alias("near"))
    end = lambda p, n: F.col(p) + F.col(n)
    every = lost.unionByName(echoes).select("d", "p", end("p", "n").alias("e"), "found_in", "p2", end("p2", "n2").alias("e2"), "near")
    # equal paragraphs stand in step with the keeper's, near ones need not: each of those is extended by itself
    equal = _merged(every.where("not near")).select("d", "first.p", "last.e", "found_in", F.col("first.found_in").alias("d1"), F.col("first.p2").alias("p2"), F.col("last.found_in").alias("d2"), F.col("last.e2").alias("e2"), F.lit(False).alias("near"))
    alone = every.where("near").select("d", "p", "e", "found_in", F.col("found_in").alias("d1"), "p2", F.col("found_in").alias("d2"), "e2", "near").dropDuplicates(["d", "p", "e"])
    spans = stored(equal.unionByName(alone), "spans")
    spans = _merged(_extended(spans, base, size + gap).withColumns({"p2": F.lit(0), "e2": F.lit(0)}))
    return spans.select(F.col("d").alias(id_col), F.col("first.p").alias("start"), (F.col("last.e") - F.col("first.p")).alias("n_words"), "found_in")


def _merged(spans: DataFrame) -> DataFrame:
    """One row for spans (d, p to e, found_in from p2 to e2) that overlap or touch, with the first and the last of them."""
    by = Window.partitionBy("d").orderBy("p", "e")
    ends = F.max("e").over(by.rowsBetween(Window.unboundedPreceding, -1))
    rows = spans.withColumn("new", (F.col("p") > F.coalesce(ends, F.lit(-1))).cast("int")).withColumn("span", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("d", "span").agg(F.min(F.struct("p", "found_in", "p2")).alias("first"), F.max(F.struct("e", "found_in", "e2")).alias("last"), F.min("found_in").alias("found_in"))


def _around(reach: int):
    """Up to ``reach`` words before (nearest first) or from each wanted place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in slices(b, "text")):
            h, bounds, _, _ = words(part.column("text"))
            wanted = part.column("wanted")
            row = np.repeat(np.arange(len(part)), np.diff(wanted.offsets.to_numpy()))
            flat = wanted.flatten()
            place, after = flat.field("place"), flat.field("after")
            found = []
            for a, to, p, forward in zip(bounds[row].tolist(), bounds[row + 1].tolist(), place.to_pylist(), after.to_pylist()):
                p = min(a + p, to)
                found.append((h[p : min(to, p + reach)] if forward else h[max(a, p - reach) : p][::-1]).view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(row)), place, after, pa.array(found, pa.list_(pa.int64()))], ["doc", "place", "after", "words"])

    return run


def _extended(spans: DataFrame, base: DataFrame, reach: int) -> DataFrame:
    """Spans (d, p, e, found_in) that begin and end with the run of equal words around them.

    A run of equal words that goes on for more than ``gap`` words beyond a span
    holds another paragraph, so ``reach`` words on either side are enough.
    """
    key = ["d", "p", "e", "near"]
    ends = [F.struct(F.lit(role).alias("role"), F.col(doc).alias("doc"), F.col(place).alias("place"), F.lit(after).alias("after")) for role, doc, place, after in (("u", "d", "p", False), ("v", "d1", "p2", False), ("x", "d", "e", True), ("y", "d2", "e2", True))]
    asked = stored(spans.select(*key, F.explode(F.array(*ends)).alias("q")).select(*key, "q.*"), "ends")
    wanted = asked.select("doc", "place", "after").distinct().groupBy("doc").agg(F.collect_list(F.struct("place", "after")).alias("wanted"))
    texts = IdFilter(asked.select("doc")).hits(base, "id").join(wanted, F.col("id") == F.col("doc")).select("id", "text", "wanted")
    around = stored(texts.mapInArrow(tidy(_around(reach)), "doc long, place long, after boolean, words array<long>").dropDuplicates(["doc", "place", "after"]), "around")
    got = asked.join(around, ["doc", "place", "after"]).groupBy(*key).agg(*[F.max(F.when(F.col("role") == r, F.col("words"))).alias(r) for r in "uvxy"])

    def alike(x: str, y: str):
        same = F.zip_with(x, y, lambda i, j: F.coalesce(i == j, F.lit(False)))
        stop = F.array_position(same, F.lit(False))
        return F.coalesce(F.when(stop == 0, F.size(same)).otherwise(stop - 1), F.lit(0))

    both = spans.join(got.select(*key, alike("u", "v").alias("before"), alike("x", "y").alias("behind")), key, "left")
    return both.select("d", (F.col("p") - F.coalesce("before", F.lit(0))).alias("p"), (F.col("e") + F.coalesce("behind", F.lit(0))).alias("e"), "found_in")


def cut_passages(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the words of ``spans``; all columns stay, and documents without spans are as they were.

    White space after a removed word goes with it. A document that loses all
    its words has an empty text. A null text stays null.
    """
    listed = spans.groupBy(F.col(id_col).alias("_cut_id")).agg(F.collect_list(F.struct("start", "n_words")).alias("_cut_spans"))
    listed_ids = IdFilter(spans.select(id_col))
    joined = listed_ids.hits(docs, id_col).join(listed, F.col(id_col) == F.col("_cut_id"), "left").drop("_cut_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in slices(b, text_col)):
            spans_at, text_at = part.schema.get_field_index("_cut_spans"), part.schema.get_field_index(text_col)
            texts, spans = part.column(text_at), part.column(spans_at).to_pylist()
            if any(spans):
                _, bounds, begin, _ = words(texts)
                data, offsets = buffers(texts)
                out = []
                for i, (text, cuts) in enumerate(zip(texts.to_pylist(), spans)):
                    if cuts and text is not None:
                        own, raw, keep, at = begin[bounds[i] : bounds[i + 1]], data[offsets[i] : offsets[i + 1]].tobytes(), [], 0
                        for s in sorted(cuts, key=lambda s: s["start"]):
                            end = s["start"] + s["n_words"]
                            a, b = int(own[s["start"]]), int(own[end]) if end < len(own) else len(raw)
                            keep.append(raw[at : max(at, a)])
                            at = max(at, b)
                        text = (b"".join(keep) + raw[at:]).decode()
                    out.append(text)
                texts = pa.array(out, pa.string())
            columns = [texts if j == text_at else x for j, x in enumerate(part.columns) if j != spans_at]
            yield pa.RecordBatch.from_arrays(columns, [n for n in part.schema.names if n != "_cut_spans"])

    return listed_ids.misses(docs, id_col).unionByName(joined.mapInArrow(tidy(run), docs.schema))
