"""Exact n-gram Jaccard join: size-banded tiles, bitmap bounds, sorted-array intersection.

**Which documents can meet.** Two sets with similarity >= t differ in at most
H = (|A| + |B|)(1 - t)/(1 + t) elements. Sizes fall into bands of ratio 1/t, so
partners are in the same or neighbouring bands, and a band bounds H. All
shingles of a document are dealt by their hash into p = H + 1 + e parts; two
partners agree in whole on at least 1 + e of them. A key is the hash of one
non-empty part (about six shingles), so partners share a key unless more than e
parts are empty in both; a document with more empty parts than e gives keys for
those as well. Shingles that many documents hold are left out of the parts, which
loses no partner, as sets differ in no more elements without them: else unrelated
documents would meet in parts that hold a boilerplate shingle and nothing else.

**What is shuffled** are (key, id) rows; equal keys within a slice of a task are
joined before, so that no key sends more than one row from each. Documents
that share a key are chained, not paired, and the chains' components gather
all possible partners of a document.

**Very large components.** Tiles are compared in pairs, so their cost grows with
the square of a component, whose documents may have met by chance, one by one.
Beyond ``anew`` sets (where that would cost more) they are keyed anew, from
their stored sets, by pairs of parts: with g more parts, partners agree on more
than g of them, so on two whose numbers are equal modulo g. A key is two such
parts, twice as many shingles as before, and chance meetings fall away. It takes
some 400 to 3,000 keys a document, so smaller components go without.

**Tiles.** A component of documents of up to ``tile`` distinct sets is one tile.
One that is larger even so is cut by size band and hash, and tiles of the same or
neighbouring bands meet. In a tile, a bitmap of each set's hashed elements
bounds every overlap from above (a bit of A that B lacks is an element that B
lacks), and only pairs that pass, and are not linked yet, are intersected. A
tile gives out a spanning forest of its links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroperf.llm.components import components
from aeroperf.llm.hashing import mix, shingle_sets, slices
from aeroperf.llm.id_filter import IdFilter
from aeroperf.llm.storage import discard, stored
from aeroperf.llm.workers import tidy

U = np.uint64
EDGE, DOC, KEY = 1, 2, 0


class Bands:
    """Size bands of ratio den/num and their numbers of parts, in whole numbers throughout."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def band(self, n: np.ndarray) -> np.ndarray:
        """Band of each size (1 or more)."""
        edges = _edges(self.num, self.den)
        return np.searchsorted(edges, n, "right") - 1

    def parts(self, band: int, paired: bool = False) -> tuple[int, int, int]:
        """(parts p, empty parts e that go without keys, g): two partners agree on more than e + g parts. g is 0 unless ``paired``."""
        return _parts(self.num, self.den, band, paired)


@lru_cache
def _edges(num: int, den: int) -> np.ndarray:
    """First size of each band: a band from ``a`` holds sizes up to a * den / num."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * den // num + 1)
    return np.array(out)


@lru_cache(maxsize=None)
def _parts(num: int, den: int, band: int, paired: bool) -> tuple[int, int, int]:
    edges = _edges(num, den)
    least, most = int(edges[band]), int(edges[band + 1]) - 1
    apart = (most + most * den // num) * (den - num) // (den + num)
    more = max(2, apart // 24) if paired else 0  # few, as parts get thinner with each; the number of pairs is at most some 13 times that of parts
    if not apart:
        return 1 + more, 0, more
    spare = 1
    for _ in range(4):  # empty parts are about Poisson; far more than their mean are not met
        p = apart + 1 + spare + more
        mean = p * math.exp(-least / p)
        spare = math.ceil(2 + mean + 5 * math.sqrt(mean))
    if apart + 1 + spare + more > 2 * least:  # tiny sets: empty parts are common, but so few that their keys are cheap
        spare = 1
    return apart + 1 + spare + more, spare, more


def part_keys(flat: np.ndarray, starts: np.ndarray, bands: Bands, common: np.ndarray | None = None, paired: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(key, document) of every part of every set, or of ``paired`` parts, for its own band and for the one below.

    ``common`` is a bitmap of shingles to leave out of the parts: two sets that
    differ in H elements differ in H at most without them. A document that is
    left with too many empty parts gives the keys of its whole set besides, and
    if those have too many as well, keys for the empty ones.
    """
    sizes = np.diff(starts)
    if common is None:
        return _keys(flat, starts, sizes, np.flatnonzero(sizes), bands, 1, paired)[:2]
    keep = (common[(flat & U(64 * len(common) - 1)) >> U(6)] >> (flat & U(63))) & U(1) == 0
    kept = np.concatenate([[0], np.cumsum(keep)])[starts]
    keys, docs, left = _keys(flat[keep], kept, sizes, np.flatnonzero(sizes), bands, 0, paired)
    more, again, _ = _keys(flat, starts, sizes, left, bands, 1, paired)
    return np.concatenate([keys, more]), np.concatenate([docs, again])


def _keys(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, docs: np.ndarray, bands: Bands, level: int, paired: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and documents, and documents with too many empty parts; at level 1 those have keys for them."""
    own, mixed = bands.band(sizes[docs]), mix(flat ^ U(0x5851F42D4C957F2D + level))
    keys, owners, left = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    held = np.diff(starts)
    for down in (0, 1):
        some, at = docs[own >= down], own[own >= down] - down
        if not len(some):
            continue
        table = {b: bands.parts(b, paired) for b in np.unique(at).tolist()}
        p, spare, more = np.array([table[b] for b in at.tolist()]).T
        p = p.astype(np.uint64)
        n = held[some]
        index = np.repeat(starts[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        row = np.repeat(np.arange(len(some)), n)
        part = ((flat[index] >> U(32)) * p[row]) >> U(32)
        begins = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (row[1:] != row[:-1])]) if len(part) else np.zeros(0, np.int64)
        r, q = row[begins], part[begins]
        h = mix(np.add.reduceat(mixed[index], begins) + _salt(at[r], q) + U(level)) if len(begins) else np.zeros(0, np.uint64)
        over = np.flatnonzero(p.astype(np.int64) - np.bincount(r, minlength=len(some)) > spare)
        left.append(some[over])
        rows, places, hashes = [r], [q], [h]
        for i in over if level else ():
            empty = np.setdiff1d(np.arange(int(p[i])), q[r == i].astype(np.int64)).astype(np.uint64)
            hashes.append(mix(_salt(np.full(len(empty), at[i]), empty) ^ U(0xE)))
            rows.append(np.full(len(empty), i))
            places.append(empty)
        r, q, h = np.concatenate(rows), np.concatenate(places), np.concatenate(hashes)
        if paired:
            r, h = _paired(r, q, h, more[r].astype(np.uint64))
        keys.append(h)
        owners.append(some[r])
    return np.concatenate(keys), np.concatenate(owners), np.unique(np.concatenate(left))


def _paired(row: np.ndarray, part: np.ndarray, h: np.ndarray, modulo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every two parts of a row whose numbers are equal modulo its ``modulo``."""
    by = np.lexsort((part, part % modulo, row))
    row, kind, h = row[by], (part % modulo)[by], h[by]
    rows, keys, step = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 1
    while step < len(row):
        both = np.flatnonzero((row[step:] == row[:-step]) & (kind[step:] == kind[:-step]))
        if not len(both):
            break
        rows.append(row[both])
        keys.append(mix(h[both] * U(3) + mix(h[both + step])))
        step += 1
    return np.concatenate(rows), np.concatenate(keys)


def _salt(band: np.ndarray, part: np.ndarray) -> np.ndarray:
    return mix((band.astype(np.uint64) << U(40)) + part + U(1))


def _repeats(k: int, most: int = 1 << 21):
    """Shingles that come in two or more documents of a stretch of a task (``most`` shingles long), with their counts. Sorted in place: a stretch is all that is held."""

    def counted(held: np.ndarray) -> pa.RecordBatch:
        held.sort()
        again = np.flatnonzero(held[1:] == held[:-1])
        first = np.flatnonzero(np.r_[True, np.diff(again) > 1]) if len(again) else again
        return pa.RecordBatch.from_arrays([pa.array(held[again[first]].view(np.int64)), pa.array(np.diff(np.r_[first, len(again)]) + 1)], ["shingle", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.empty(most, np.uint64), 0
        for part in (p for b in batches for p in slices(b, "text")):
            flat, at = shingle_sets(part.column("text"), k)[0], 0
            while at < len(flat):
                some = flat[at : at + most - n]
                held[n : n + len(some)] = some
                n, at = n + len(some), at + len(some)
                if n == most:
                    yield counted(held)
                    n = 0
        if n:
            yield counted(held[:n])

    return run


def common_shingles(base: DataFrame, k: int, least: int = 16, most_bits: int = 1 << 26) -> np.ndarray:
    """Bitmap of shingles that many documents hold: boilerplate, which would make unrelated documents share a part.

    Counts are of all documents; what comes only once in a stretch of a task
    is not sent. Which shingles count as common decides how much work is done,
    not which links are found. The bitmap has 8 bits for each of them and at
    most ``most_bits`` (8 MB) in all: the least count doubles until they fit.
    """
    counts = stored(base.mapInArrow(tidy(_repeats(k)), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "common-shingles")
    sizes = {r["b"]: r["c"] for r in counts.groupBy(F.floor(F.log2("n")).alias("b")).agg(F.count("*").alias("c")).collect()}
    while sum(c for b, c in sizes.items() if 2**b >= least) * 8 > most_bits:
        least *= 2
    total = sum(c for b, c in sizes.items() if 2**b >= least)
    bits = min(most_bits, 1 << max(10, (8 * total).bit_length()))
    word = F.shiftright(F.col("shingle").bitwiseAND(F.lit(bits - 1)), 6)
    words = counts.where(F.col("n") >= least).groupBy(word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(shingle & 63 AS int))")).alias("bits")).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    discard(counts)
    return out


def _signatures(k: int, bands: Bands, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in slices(b, "text")):
            ids = part.column("id")
            flat, starts = shingle_sets(part.column("text"), k)
            n, whole = len(ids), ids.is_valid().to_numpy(zero_copy_only=False)
            number = ids.fill_null(0).to_numpy()
            yield _rows(mix(np.arange(n, dtype=np.uint64) + mix(number.view(np.uint64))).view(np.int64), ids, pa.array(np.diff(starts)), DOC)
            keys, doc = part_keys(flat, starts, bands, common.value)
            keep = whole[doc]
            yield from _key_rows(keys[keep], doc[keep], number)

    return run


def _key_rows(keys: np.ndarray, doc: np.ndarray, number: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each key, of its first document, and edges to the others that have it; documents are places in ``number``, their ids."""
    n = len(number)
    order = np.argsort(keys, kind="stable")
    keys, doc = keys[order], doc[order]
    first = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
    lead = np.flatnonzero(first)
    yield _rows(keys[lead].view(np.int64), pa.array(number[doc[lead]]), pa.nulls(len(lead), pa.int64()), KEY)
    leader = doc[np.repeat(lead, np.diff(np.r_[lead, len(keys)]))]
    pair = np.unique(leader[~first] * n + doc[~first])
    a, b = number[pair // n], number[pair % n] if n else pair
    yield _rows(mix(a.view(np.uint64) ^ mix(b.view(np.uint64))).view(np.int64), pa.array(a), pa.array(b), EDGE)


def _pair_keys(bands: Bands, common):
    """The same rows from stored sets, by paired parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in slices(b, "shingles")):
            raw = part.column("shingles").to_pylist()
            starts = np.cumsum([0, *(len(x) // 8 for x in raw)])
            keys, doc = part_keys(np.frombuffer(b"".join(raw), np.uint64), starts, bands, common.value, paired=True)
            yield from _key_rows(keys, doc, part.column("id").to_numpy())

    return run


def _rows(key: np.ndarray, a: pa.Array, b: pa.Array, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key), a, b, pa.array(np.full(len(key), kind, np.int8))], ["key", "a", "b", "kind"])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between documents that share a key; edges and documents pass through."""
    keys, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        at = kind == KEY
        keys.append(batch.column("key").to_numpy()[at])
        ids.append(batch.column("a").filter(pa.array(at)).to_numpy())
        yield batch.filter(pa.array(~at)).select(["a", "b", "kind"])
    key, doc = np.concatenate(keys), np.concatenate(ids)
    order = np.argsort(key)
    key, doc = key[order], doc[order]
    same = np.flatnonzero((key[1:] == key[:-1]) & (doc[1:] != doc[:-1]))
    pairs = np.unique(np.stack([np.minimum(doc[same], doc[same + 1]), np.maximum(doc[same], doc[same + 1])], 1), axis=0)
    for at in range(0, len(pairs), 100_000):
        some = pairs[at : at + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(some[:, 0].copy()), pa.array(some[:, 1].copy()), pa.array(np.full(len(some), EDGE, np.int8))], ["a", "b", "kind"])


def _sets(k: int):
    """Rows with their sets; a row whose set stands above it in the slice has a null one and names its holder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in slices(b, "text")):
            flat, starts = shingle_sets(part.column("text"), k)
            ids = part.column("id").to_pylist()
            met: dict[bytes, int] = {}
            raw, holder = [], []
            for i, name in enumerate(ids):
                own = flat[starts[i] : starts[i + 1]].tobytes()
                holder.append(met.setdefault(own, name))
                raw.append(own if holder[-1] == name else None)
            yield pa.RecordBatch.from_arrays([part.column("whole"), part.column("id"), pa.array(holder, pa.int64()), pa.array(np.diff(starts)), pa.array(raw, pa.binary())], ["whole", "id", "holder", "n", "shingles"])

    return run


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct numbers."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def tile_links(sets: list[np.ndarray], side: np.ndarray | None, num: int, den: int, owner: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs (i, j) with similarity >= num/den: of all pairs, or of those between two sides. Sets of one ``owner`` are not paired."""
    n = np.array([len(s) for s in sets])
    if len(n) < 2:
        return []
    bits = 1 << min(14, max(6, math.ceil(math.log2(4 * n.max()))))
    maps = np.zeros((len(n), bits // 64), np.uint64)
    for low in range(0, len(n), 128):
        some, wide = sets[low : low + 128], n[low : low + 128]
        block = np.zeros((len(some), bits), bool)
        block[np.repeat(np.arange(len(some)), wide), (np.concatenate(some) & U(bits - 1)).astype(np.int64)] = True
        maps[low : low + 128] = np.packbits(block, axis=1).view(np.uint64)
    by_size = np.argsort(n, kind="stable")
    left, right = (by_size, by_size) if side is None else (by_size[side[by_size] == 0], by_size[side[by_size] == 1])
    sizes, label, out = n[right], np.arange(len(n)), []
    for place, i in enumerate(left):
        lo = place + 1 if side is None else np.searchsorted(sizes, -(-n[i] * num // den), "left")
        hi = np.searchsorted(sizes, n[i] * den // num, "right")
        j = right[lo:hi]
        j = j[label[j] != label[i]]
        if owner is not None:
            j = j[owner[j] != owner[i]]
        for at in range(0, len(j), 512):
            some = j[at : at + 512]
            lacks = np.bitwise_count(maps[i] & ~maps[some]).sum(1, dtype=np.int64)
            excess = np.bitwise_count(maps[some] & ~maps[i]).sum(1, dtype=np.int64)
            most = np.minimum(n[i] - lacks, n[some] - excess)
            for m in some[most * (num + den) >= num * (n[i] + n[some])]:
                if label[m] != label[i] and overlap(sets[i], sets[m]) * (num + den) >= num * (n[i] + n[m]):
                    out.append((int(i), int(m)))
                    label[label == label[m]] = label[i]
    return out


def _tile(num: int, den: int):
    def run(table: pa.Table) -> pa.Table:
        whole, name, side = (table.column(c).to_numpy() for c in ("whole", "id", "side"))
        cross = bool(table.column("cross")[0].as_py())
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        a, b = [], []
        order = np.argsort(whole, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(whole[order])) + 1):
            for i, j in tile_links([sets[x] for x in at], side[at] if cross else None, num, den):
                a.append(name[at[i]])
                b.append(name[at[j]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def jaccard_components(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text", tile: int = 1024, tile_shingles: int = 1 << 21, anew: int = 1 << 16) -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id reachable by links, itself included).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A document's set is
    its distinct ``k``-word shingles; with fewer words the whole sequence is
    one; without words or text the set is empty and links with nothing.
    Documents link when den * intersection >= num * union, exactly (up to
    64-bit hashes). A null id takes no part and has a null component. Rows that
    repeat an id are kept and are one document, linked where one of them is.
    Other columns are not carried.
    """
    bands = Bands(num, den)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(base, k))
    signed = base.mapInArrow(tidy(_signatures(k, bands, common)), "key long, a long, b long, kind byte")
    met = stored(signed.repartition("key").mapInArrow(tidy(_chain), "a long, b long, kind byte"), "shared-keys")
    rows = met.where(F.col("kind") == DOC).select(F.col("a").alias("id"), F.col("b").alias("n_shingles"))
    groups = components(met.where(F.col("kind") == EDGE).select("a", "b"))

    possible = IdFilter(groups.select("node")).hits(base, "id")
    near = possible.join(groups.select(F.col("node").alias("id"), F.col("component").alias("whole")), "id").select("whole", "id", "text")
    members = stored(near.mapInArrow(tidy(_sets(k)), "whole long, id long, holder long, n long, shingles binary"), "sets")
    too_many = (F.col("sets") > tile) | (F.col("elements") > tile_shingles)
    large = stored(members.where("shingles is not null").groupBy("whole").agg(F.count("*").alias("sets")).where(F.col("sets") > anew).select("whole"), "large-groups")
    if not large.isEmpty():
        inside = members.where("shingles is not null").join(large, "whole", "left_semi")
        again = inside.select("id", "shingles").mapInArrow(tidy(_pair_keys(bands, common)), "key long, a long, b long, kind byte")
        again = again.repartition("key").mapInArrow(tidy(_chain), "a long, b long, kind byte")
        parted = components(again.select("a", "b")).select(F.col("node").alias("id"), F.col("component").alias("part"))
        split = inside.join(parted, "id", "left").select(F.coalesce("part", "id").alias("whole"), "id", "holder", "n", "shingles")
        rest = members.join(large, "whole", "left_anti").unionByName(members.where("shingles is null").join(large, "whole", "left_semi"))
        members = stored(rest.unionByName(split), "sets")
    edges = np.asarray(_edges(num, den))
    edges = edges[edges < 1 << 31].tolist()
    band = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= F.col("n"))) - 1
    sets = members.where("shingles is not null").withColumn("band", band)

    tiles = F.greatest(F.ceil(F.col("sets") / tile), F.ceil(F.col("elements") / tile_shingles)).cast("int")
    per_band = sets.groupBy("whole", "band").agg(F.count("*").alias("sets"), F.sum("n").alias("elements")).withColumn("tiles", tiles)
    sizes = per_band.groupBy("whole").agg(F.sum("sets").alias("sets"), F.sum("elements").alias("elements"), F.map_from_entries(F.collect_list(F.struct("band", "tiles"))).alias("tiles"))
    large = stored(sizes.where(too_many).select("whole", "tiles"), "large-groups")
    total = members.agg(F.count("shingles")).first()[0]
    buckets = max(1, total // 512)

    # one row for each component of more than a tile: Spark broadcasts the table while it is small
    dealt = sets.join(large, "whole", "left").withColumn("small", F.col("tiles").isNull())
    own = F.pmod(F.xxhash64(F.lit(3), "id"), F.col("tiles")[F.col("band")]).cast("int")
    dealt = dealt.withColumn("own", F.when(F.col("small"), 0).otherwise(own))

    def meets(step: int):
        """Tiles of the band ``step`` away, as (lower band, its tile, upper band, its tile, side, cross)."""
        there = F.col("tiles")[F.col("band") + step]
        others = F.sequence(F.lit(0), F.coalesce(there, F.lit(1)) - 1)
        lower, upper = F.col("band") + min(step, 0), F.col("band") + max(step, 0)

        def pair(o):
            if step > 0:
                return F.struct(lower.alias("b1"), F.col("own").alias("t1"), upper.alias("b2"), o.alias("t2"), F.lit(0).alias("side"), F.lit(True).alias("cross"))
            if step < 0:
                return F.struct(lower.alias("b1"), o.alias("t1"), upper.alias("b2"), F.col("own").alias("t2"), F.lit(1).alias("side"), F.lit(True).alias("cross"))
            return F.struct(lower.alias("b1"), F.least("own", o).alias("t1"), upper.alias("b2"), F.greatest(F.col("own"), o).alias("t2"), (F.col("own") > o).cast("int").alias("side"), (F.col("own") != o).alias("cross"))

        return F.when(there.isNull(), F.array().cast("array<struct<b1:int,t1:int,b2:int,t2:int,side:int,cross:boolean>>")).otherwise(F.transform(others, pair))

    alone = F.array(F.struct(F.lit(-1).alias("b1"), F.lit(0).alias("t1"), F.lit(-1).alias("b2"), F.lit(0).alias("t2"), F.lit(0).alias("side"), F.lit(False).alias("cross")))
    where = F.when(F.col("small"), alone).otherwise(F.concat(meets(0), meets(1), meets(-1)))
    room = F.when(F.col("small"), F.pmod(F.xxhash64("whole"), F.lit(buckets))).otherwise(F.col("whole"))
    dealt = dealt.select(room.alias("room"), "whole", "id", "shingles", F.explode(where).alias("m")).select("room", "whole", "id", "shingles", "m.*")
    links = stored(dealt.groupBy("room", "b1", "t1", "b2", "t2").applyInArrow(_tile(num, den), "a long, b long"), "links")
    equal = members.where("holder <> id").select(F.col("id").alias("a"), F.col("holder").alias("b"))
    roots = components(links.union(equal))
    out = rows.join(roots.withColumnRenamed("node", "id"), "id", "left").select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"))
    discard(members, links)
    return out
