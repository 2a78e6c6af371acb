"""Near duplicates among embeddings by randomised-rotation binary codes.

A unit vector ``o`` is rotated at random and each coordinate reduced to its
sign: the code ``x``, a unit vector of entries of +-1/sqrt(D). With the factor
``f = <x, o>``, ``<x, q> / f`` is an unbiased estimate of the inner product of
``o`` with any unit vector ``q``, off by more than ``eps * sqrt((1 - f^2) / f^2
/ (D - 1))`` with a probability that falls as exp(-c eps^2). What is stored for
each vector, once, are the code, the factor, and for its turn as ``q`` the
rotated coordinates in a byte each; the bytes' rounding widens the bound by
``step / 2 * sqrt(D) / f``. Pairs whose upper bound is below the threshold are
settled; only vectors with an undecided partner are fetched, and only undecided
pairs are recomputed, exactly, in double precision.

Which pairs are estimated at all is decided by bands of the same signs: two
vectors meet where they agree on all bits of one of the bands. A bit differs
with probability ``arccos(threshold) / pi`` at the threshold (0.064 at 0.98).
A band has four bits more than the largest group's size asks for, so that
about one in sixteen vectors meets an unlike one in a band, at any size, and there are as many bands as
miss a pair at the threshold with probability ``miss``. Buckets are dealt to
rooms, many small ones to each; one of more than ``tile`` vectors is cut by
hash, and all its tiles meet. A pair counts in the first band where it meets, so
its link is counted once. A room gives out sums and a spanning forest, never its
pairs: output follows the rows. Exact copies are one vector with a count from
the start.
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
from aeroperf.llm.hashing import mix
from aeroperf.llm.id_filter import IdFilter
from aeroperf.llm.storage import discard, release, stored
from aeroperf.llm.vectors import by_width, rotation
from aeroperf.llm.workers import tidy

#: Signs, factor, and rotated coordinates in bytes with the size of their step.
CODE = "signs binary, factor double, bytes binary, step double"
ROOM = ["room", "lo", "hi"]
PAIRS = 1 << 17  # looked at at once


def tune_bits(threshold: float, largest: int, miss: float) -> tuple[int, int]:
    """(bits of a band, bands) for groups of up to ``largest`` vectors: a pair at the threshold meets in no band with probability ``miss`` at most.

    A low threshold gets shorter bands, and so more work, rather than thousands of them.
    """
    alike = 1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    bits = min(60, max(8, math.ceil(math.log2(max(2, largest))) + 4))
    bands = lambda b: max(1, math.ceil(math.log(miss) / math.log1p(-(alike**b)))) if alike < 1 else 1
    while bits > 1 and bands(bits) > 256:
        bits -= 1
    return bits, bands(bits)


@lru_cache(maxsize=4)
def _turns(width: int, n_bits: int, seed: int) -> np.ndarray:
    """Columns to project on for ``n_bits`` signs: whole rotations side by side, the first of them the code's."""
    return np.concatenate([rotation(width, seed + i) for i in range(max(1, -(-n_bits // width)))], 1)[:, : max(width, n_bits)]


def encode(u: np.ndarray, n_bits: int, seed: int) -> list[pa.Array]:
    """The columns of CODE of unit vectors; signs are those of the first rotation and as many more as bands need."""
    width = u.shape[1]
    turned = u @ _turns(width, n_bits, seed)
    signs, first = turned > 0, turned[:, :width]
    factor = np.abs(first).sum(1) / math.sqrt(width)
    step = np.maximum(np.abs(first).max(1), 1e-300) / 127
    raw = np.rint(first / step[:, None]).astype(np.int8)
    binary = lambda x: pa.array([r.tobytes() for r in x], pa.binary())
    return [binary(np.packbits(signs, axis=1, bitorder="little")), pa.array(factor), binary(raw), pa.array(step)]


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


def _band_values(signs: np.ndarray, bands: int, bits: int) -> np.ndarray:
    """The bits of each band of each row as a number; ``signs`` are packed."""
    flat = np.unpackbits(signs, axis=1, bitorder="little", count=bands * bits).reshape(len(signs), bands, bits)
    return flat @ (np.int64(1) << np.arange(bits))


class Room:
    """Vectors of one room: buckets of one width that are compared within, or two sides of a large one."""

    def __init__(self, table: pa.Table, bands: int, bits: int, threshold: float, eps: float):
        column = lambda c: table.column(c).combine_chunks()
        self.cls, self.band, self.side = (column(c).to_numpy() for c in ("cls", "band", "side"))
        self.cross = table.column("lo")[0].as_py() != table.column("hi")[0].as_py()
        g, bucket = column("g").to_numpy(), column("bucket").to_numpy()
        order = np.lexsort((self.cls, bucket, g))
        new = (np.diff(g[order]) != 0) | (np.diff(bucket[order]) != 0)
        self.threshold, self.cuts = threshold, np.split(order, np.flatnonzero(new) + 1) if len(order) else []
        signs, q, factor, step = _matrix(column("signs"), "u1"), _matrix(column("bytes"), "i1"), column("factor").to_numpy(), column("step").to_numpy()
        width = q.shape[1]
        self.values = _band_values(signs, bands, bits)
        code = np.unpackbits(signs, axis=1, bitorder="little", count=width).astype(np.float32) * 2 - 1
        self.code, self.turned, self.step = code / (math.sqrt(width) * factor)[:, None].astype(np.float32), q.astype(np.float32) * step[:, None].astype(np.float32), step
        self.slack = eps * np.sqrt(np.maximum(1 - factor**2, 0) / np.maximum(factor**2, 1e-12) / max(width - 1, 1)) + 1e-5
        self.rounding = math.sqrt(width) / np.maximum(factor, 1e-12) / 2

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Undecided pairs (i, j) of rows: those whose upper bound reaches the threshold and that have met in no band before."""
        left, right, held = [], [], 0
        for at in self.cuts:
            if len(at) > 64 or self.cross:
                a, b = (at[self.side[at] == 0], at[self.side[at] == 1]) if self.cross else (at, at)
                rows = max(1, PAIRS // max(1, len(b)))
                for low in range(0, len(a), rows):
                    some = a[low : low + rows]
                    bound = self.code[some] @ self.turned[b].T + self.slack[some, None] + self.rounding[some, None] * self.step[b]
                    may = bound >= self.threshold
                    if not self.cross:
                        may &= np.arange(low, low + len(some))[:, None] < np.arange(len(b))
                    for earlier in range(int(self.band[at[0]]) if may.any() else 0):
                        may &= self.values[some, earlier, None] != self.values[b, earlier]
                    x, y = np.nonzero(may)
                    yield some[x], b[y]
                continue
            x, y = np.triu_indices(len(at), 1)
            left.append(at[x])
            right.append(at[y])
            held += len(x)
            if held >= PAIRS:
                yield self._few(left, right)
                left, right, held = [], [], 0
        if held:
            yield self._few(left, right)

    def _few(self, left: list, right: list) -> tuple[np.ndarray, np.ndarray]:
        i, j = np.concatenate(left), np.concatenate(right)
        bound = np.einsum("ij,ij->i", self.code[i], self.turned[j]) + self.slack[i] + self.rounding[i] * self.step[j]
        i, j = i[bound >= self.threshold], j[bound >= self.threshold]
        before = np.arange(self.values.shape[1]) < self.band[i][:, None]
        apart = ~((self.values[i] == self.values[j]) & before).any(1)
        return i[apart], j[apart]


def _open_rows(bands: int, bits: int, threshold: float, eps: float):
    """Rows of a room that have an undecided partner in it."""

    def run(table: pa.Table) -> pa.Table:
        room, hit = Room(table, bands, bits, threshold, eps), np.zeros(len(table), bool)
        for i, j in room.pairs():
            hit[i] = hit[j] = True
        return table.filter(pa.array(hit))

    return run


def _exact(bands: int, bits: int, threshold: float, eps: float, kind: str):
    """Number of linked vectors of each class in a room, and the smallest class that its links reach."""

    def run(table: pa.Table) -> pa.Table:
        room, weight = Room(table, bands, bits, threshold, eps), table.column("weight").to_numpy()
        x = _matrix(table.column("v").combine_chunks(), kind).astype(np.float64)
        x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])  # exact, and keeps squares in range
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        n, label = np.zeros(len(table), np.int64), room.cls.copy()
        edges = []
        for i, j in room.pairs():
            product = np.concatenate([np.einsum("ij,ij->i", x[i[a : a + 4096]], x[j[a : a + 4096]]) for a in range(0, len(i), 4096)] or [np.zeros(0)])
            near = product / (norm[i] * norm[j]) >= threshold
            i, j = i[near], j[near]
            np.add.at(n, i, weight[j])
            np.add.at(n, j, weight[i])
            edges += [np.stack([i, j])] if len(i) else []
        edges = np.concatenate(edges, 1) if edges else np.zeros((2, 0), np.int64)
        while True:  # smallest class over links, until nothing changes
            before = label.copy()
            np.minimum.at(label, edges[0], label[edges[1]])
            np.minimum.at(label, edges[1], label[edges[0]])
            if (before == label).all():
                break
        hit = np.flatnonzero(n)
        return pa.table({"cls": room.cls[hit], "links": n[hit], "other": label[hit]})

    return run


def near_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", group: str = "label", threshold: float = 0.98, miss: float = 4e-6, tile: int = 1024, eps: float = 6.0, seed: int = 5) -> DataFrame:
    """Per row: id, n_links (other vectors of its group at cosine >= ``threshold``), component_id, kept.

    component_id is the smallest id reachable by links, kept whether it is the
    vector's own. Vectors that are null, empty, zero or hold a null or
    non-finite component, and rows of a null group or id, link with nothing and
    are components of their own. Only vectors of the same width are compared.
    The group may be of any type that can be grouped by. Repeated rows of one id
    are separate vectors: every row comes back once, and ``n_links`` counts
    rows. Other columns are not carried. An empty table gives an empty one. The
    links found are exact; a pair at the threshold is missed with probability
    ``miss`` at most.
    """
    kind = "<f4" if dict(vectors.dtypes)[vector] == "array<float>" else "<f8"
    base = vectors.select(F.col(id_col).alias("id"), F.col(group).alias("label"), F.col(vector).alias("v"))
    take_part = F.col("id").isNotNull() & F.col("label").isNotNull()
    base = base.select("id", F.when(take_part, F.xxhash64(F.lit("group"), "label")).alias("g"), F.when(take_part, F.col("v")).alias("v"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw: list[bytes | None] = [None] * len(batch)
            for x, at in by_width(batch.column("v")):
                for i, row in zip(at.tolist(), (x + 0.0).astype(kind)):
                    raw[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("g"), pa.array(raw, pa.binary())], ["id", "g", "v"])

    id_type = dict(base.dtypes)["id"]
    every = base.mapInArrow(tidy(clean), f"id {id_type}, g long, v binary")
    every = stored(every.withColumns({"g": F.xxhash64("g", F.length("v")), "k1": F.xxhash64("v", "g"), "k2": F.xxhash64(F.lit("k2"), "v", "g")}), "vectors")
    usable = every.where("v is not null")
    classes = usable.groupBy("g", "k1", "k2").agg(F.min("id").alias("least"), F.count("*").alias("weight"), F.first("v").alias("v"))
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    largest = classes.groupBy("g").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    bits, bands = tune_bits(threshold, largest, miss)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("v").to_pylist()], np.int64)
            for size in np.unique(sizes):
                own = batch.filter(pa.array(sizes == size))
                x = _matrix(own.column("v"), kind).astype(np.float64)
                u = x / np.abs(x).max(1, keepdims=True)
                u /= np.linalg.norm(u, axis=1, keepdims=True)
                yield pa.RecordBatch.from_arrays([own.column("cls"), own.column("g"), *encode(u, bands * bits, seed)], ["cls", "g", "signs", "factor", "bytes", "step"])

    codes = stored(classes.select("cls", "g", "v").mapInArrow(tidy(coded), f"cls long, g long, {CODE}"), "vector-codes")

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(s) for s in batch.column("signs").to_pylist()], np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                value = _band_values(_matrix(batch.column("signs").take(pa.array(at)), "u1"), bands, bits)
                g = batch.column("g").to_numpy()[at].view(np.uint64)
                key = mix(mix(value.astype(np.uint64) + g[:, None]) + np.arange(bands, dtype=np.uint64))
                row = pa.array(np.repeat(at, bands))
                yield pa.RecordBatch.from_arrays([batch.column("cls").take(row), batch.column("g").take(row), batch.column("width").take(row), pa.array(key.ravel().view(np.int64)), pa.array(np.tile(np.arange(bands, dtype=np.int32), len(at)))], ["cls", "g", "width", "bucket", "band"])

    keyed = codes.select("cls", "g", F.length("bytes").alias("width"), "signs").mapInArrow(tidy(banded), "cls long, g long, width int, bucket long, band int")
    sizes = stored(keyed.groupBy("g", "bucket").agg(F.count("*").alias("size")).where("size > 1").withColumn("tiles", F.ceil(F.col("size") / tile).cast("int")), "bucket-sizes")
    rows = sizes.agg(F.sum("size")).first()[0] or 0
    # small buckets of one width share rooms of about a tile's rows
    room = F.when(F.col("tiles") == 1, F.xxhash64("width", F.pmod("bucket", F.lit(max(1, rows // tile))))).otherwise(F.xxhash64(F.lit("large"), "g", "bucket"))
    dealt = IdFilter(sizes.select("bucket")).hits(keyed, "bucket").join(sizes, ["g", "bucket"]).withColumn("own", F.pmod(F.xxhash64(F.lit(seed), "cls"), F.col("tiles")).cast("int"))
    # every pair of tiles meets once: own tile i goes to (i, j) as the left and to (j, i) as the right side
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("cls", "g", "bucket", "band", room.alias("room"), F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    schema = f"cls long, g long, bucket long, band int, room long, lo int, hi int, side int, {CODE}"
    opened = dealt.join(codes.drop("g"), "cls").select(*[c.split()[0] for c in schema.split(", ")]).groupBy(*ROOM).applyInArrow(_open_rows(bands, bits, threshold, eps), schema)
    opened = stored(opened, "undecided")
    discard(codes, sizes)
    release(vectors.sparkSession)
    fetched = opened.join(classes.select("cls", "weight", "v"), "cls")
    found = stored(fetched.groupBy(*ROOM).applyInArrow(_exact(bands, bits, threshold, eps, kind), "cls long, links long, other long"), "vector-links")
    discard(opened)
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cls").alias("a"), F.col("other").alias("b")))
    least = roots.join(classes.select(F.col("cls").alias("node"), "least"), "node").groupBy("component").agg(F.min("least").alias("component_id"))
    linked = links.join(roots.join(least, "component").select(F.col("node").alias("cls"), "component_id"), "cls")
    per_class = classes.select("g", "k1", "k2", "cls", "weight", "least").join(linked, "cls", "left")
    per_class = stored(per_class.select("g", "k1", "k2", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id")), "class-links")
    discard(classes, found)
    members = usable.select("id", "g", "k1", "k2").join(per_class, ["g", "k1", "k2"]).select("id", "n_links", "component_id")
    alone = every.where("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = members.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
