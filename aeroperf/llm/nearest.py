"""Approximate nearest neighbours by shifted space-filling curves.

Each of ``orderings`` curves projects the vectors at random to a few
dimensions, shifts and quantises them, and takes their Hilbert keys. Spark
sorts (ordering, key, class) by range partitioning; what is sorted, ranked and
met are narrow rows, never vectors. A query's candidates are the rows within
``reach`` ranks of its own in any ordering: blocks of consecutive ranks list
them, the lists of all orderings are dealt to parts of the vectors by the
candidate, and a part, in which every vector stands once, drops repeats and
compares each candidate once, in double precision. The parts' best are merged.

How far windows must reach depends on the data: vectors without structure
need much wider ones than clustered ones. The reach is fitted on a bounded sample
of queries (``calibrate``): each one's true neighbours are found by one pass
over all rows, and the reach is the least under which ``target`` of them lie
within it in some ordering. Every row is indexed and every query searched.

Equal vectors are one class of the index with its smallest ids, so that a
vector with a million copies costs what any other does, and ties go to the
smallest ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroperf.llm.hashing import mix
from aeroperf.llm.storage import discard, stored
from aeroperf.llm.vectors import by_width, rotation
from aeroperf.llm.workers import tidy

U = np.uint64


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of ``cells`` (integers below 2^bits); at most 63 bits in all.

    The transpose form: Gray decoding of the axes from the top bit down, then their bits interleaved.
    """
    x = [c.astype(np.uint64) for c in cells.T]
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = U(q - 1)
        for i in range(len(x)):
            high = (x[i] & U(q)) != 0
            swap = np.where(high, U(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(cells), np.uint64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip = np.where((x[-1] & U(q)) != 0, flip ^ U(q - 1), flip)
    key = np.zeros(len(cells), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = key << U(1) | ((axis ^ flip) >> U(bit)) & U(1)
    return key


def ordering_keys(x: np.ndarray, ordering: int, dims: int, bits: int, seed: int, center: np.ndarray, scale: float) -> np.ndarray:
    """Hilbert keys of one shifted ordering, as signed integers."""
    dims = min(dims, x.shape[1])
    turn = rotation(x.shape[1], seed + ordering)[:, :dims]
    shift = np.random.default_rng(seed + ordering).random(dims)
    place = ((x - center) @ turn) / scale  # about one standard deviation a unit
    cells = np.clip((place + 4 + shift) / 9 * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
    return hilbert_keys(cells, bits).view(np.int64)


def _unpack(column: pa.Array, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width).astype(np.float64)


def _best(query: np.ndarray, x: np.ndarray, ids: np.ndarray, keep: int, rough: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances) of the ``keep`` nearest rows, ties to smaller ids; distances are summed from differences.

    ``rough`` are the rows' squared distances less the query's own square, as products give them.
    """
    rough = (x**2).sum(1) - 2 * x @ query if rough is None else rough
    if len(rough) > keep:
        edge = np.partition(rough, keep - 1)[keep - 1]
        near = np.flatnonzero(rough <= edge + 1e-9 * (1 + abs(edge) + query @ query))
    else:
        near = np.arange(len(rough))
    exact = ((x[near] - query) ** 2).sum(1)
    order = np.lexsort((ids[near], exact))[:keep]
    return ids[near][order], exact[order]


def _listed(parts: int, reach: int):
    """Candidates of the queries that visit a block of one ordering, as lists by part."""

    def run(table: pa.Table) -> pa.Table:
        asks, cls, rank = table.column("asks").to_numpy(zero_copy_only=False), table.column("cls").to_numpy(), table.column("rank").to_numpy()
        rows = np.flatnonzero(~asks)
        rows = rows[np.argsort(rank[rows])]
        rank_of, member = rank[rows], cls[rows]
        part = (mix(member.astype(np.uint64)) % U(parts)).astype(np.int64)
        query, to, lists = [], [], []
        for i in np.flatnonzero(asks) if len(rows) else ():
            low, high = np.searchsorted(rank_of, (rank[i] - reach, rank[i] + reach + 1))
            by = low + np.argsort(part[low:high], kind="stable")
            cuts = np.flatnonzero(np.diff(part[by])) + 1
            for at in np.split(by, cuts) if len(by) else ():
                query.append(cls[i])
                to.append(part[at[0]])
                lists.append(member[at])
        return pa.table({"query": pa.array(query, pa.int64()), "part": pa.array(to, pa.int64()), "listed": pa.array(lists, pa.list_(pa.int64()))})

    return run


def _compared(width: int, kind: str, keep: int):
    """The nearest candidates of each query among a part's vectors, each compared once."""

    def run(table: pa.Table) -> pa.Table:
        column = lambda c: table.column(c).combine_chunks()
        cls, listed, v = column("cls").to_numpy(), column("listed"), column("v")
        is_list, is_row = listed.is_valid().to_numpy(zero_copy_only=False), ~column("asks").to_numpy(zero_copy_only=False)
        rows, asking = np.flatnonzero(is_row), np.flatnonzero(~is_row & ~is_list)
        rows = rows[np.argsort(cls[rows])]
        ids, x = cls[rows], _unpack(v.take(pa.array(rows)), width, kind)
        by_id = np.lexsort((ids, column("least").fill_null(0).to_numpy()[rows]))  # of equally near classes that with the smallest id is first
        tie = np.argsort(by_id)
        square = (x**2).sum(1)
        lists = np.flatnonzero(is_list)
        lists = lists[np.argsort(cls[lists], kind="stable")]
        bounds = np.searchsorted(cls[lists], (cls[asking], cls[asking] + 1))
        out: list[list] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        for low in range(0, len(asking), 64):
            some = asking[low : low + 64]
            q = _unpack(v.take(pa.array(some)), width, kind)
            at = [np.unique(np.searchsorted(ids, listed.take(pa.array(lists[a:b])).flatten().to_numpy())) for a, b in bounds[:, low : low + 64].T]
            dense = sum(map(len, at)) * 4 > len(ids) * len(some)
            rough = square[:, None] - 2 * (x @ q.T) if dense else None
            for j, i in enumerate(some):
                near, d = _best(q[j], x[at[j]], tie[at[j]], keep, rough[at[j], j] if dense else None)
                out[0].append(np.full(len(near), cls[i]))
                out[1].append(ids[by_id[near]])
                out[2].append(d)
        return pa.table({"query": np.concatenate(out[0]), "cls": np.concatenate(out[1]), "d": np.concatenate(out[2])})

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector: str = "embedding", orderings: int = 32, dims: int = 8, bits: int = 7, calibrate: int = 64, target: float = 0.97, part_rows: int = 8192, part_pairs: int = 1 << 22, room_ids: int = 1 << 24, seed: int = 11) -> DataFrame:
    """For each id with a row where ``is_query``: its ``k`` nearest found among the rows of all other ids, by Euclidean distance.

    Returns query_id, rank (from 1), vec_id, score (the distance, exact on the
    original vectors); ties go to the smaller id. Vectors that are null, empty,
    zero or hold a null or non-finite component, those of another width than
    most (of equally common widths the smaller counts), and rows with a null
    id take no part. Repeated rows of one id count once; of an id with several
    vectors the nearest counts, on either side. With fewer than ``k``
    candidates all are returned; an empty table gives no row. Other columns are
    not carried.
    """
    spark = vectors.sparkSession
    kind = "<f4" if dict(vectors.dtypes)[vector] == "array<float>" else "<f8"
    base = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("q"), F.col(vector).alias("v"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, at in by_width(batch.column("v")):
                raw = [r.tobytes() for r in (x + 0.0).astype(kind)]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), batch.column("q").take(pa.array(at)), pa.array(raw, pa.binary())], ["id", "q", "v"])

    usable = base.mapInArrow(tidy(clean), "id long, q boolean, v binary").withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit("v2"), "v")})
    usable = stored(usable, "vectors")
    widths = usable.groupBy(F.length("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not widths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = widths[0]["n"]
    width = size // np.dtype(kind).itemsize
    usable = usable.where(F.length("v") == size)

    # an id's further vectors may take places among the best that then fall away
    held = usable.select("id", "k1", "k2").distinct().groupBy("id").agg(F.count("*").alias("n"))
    keep = k + held.agg(F.max("n")).first()[0]
    # equal vectors: their smallest ids, through salted parts so that no copy's group meets in one task
    salted = Window.partitionBy("k1", "k2", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    few = usable.select("id", "k1", "k2").distinct().withColumn("n", F.row_number().over(salted)).where(F.col("n") <= k + 1).drop("n")
    ids = few.groupBy("k1", "k2").agg(F.slice(F.sort_array(F.collect_list("id")), 1, k + 1).alias("ids"))
    whole = usable.groupBy("k1", "k2").agg(F.max("q").alias("q"), F.first("v").alias("v"), F.min("id").alias("least"))
    classes = stored(whole.join(ids, ["k1", "k2"]).withColumn("cls", F.monotonically_increasing_id()), "vector-classes")

    moments = classes.select("v").mapInArrow(tidy(_moments(width, kind)), "n long, s array<double>, ss double").toArrow()
    n = sum(moments.column("n").to_pylist())
    center = np.sum(np.array(moments.column("s").to_pylist()), 0) / n
    scale = math.sqrt(max((sum(moments.column("ss").to_pylist()) / n - center @ center) / width, 1e-300))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unpack(batch.column("v"), width, kind)
            for o in range(orderings if len(x) else 0):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), o, np.int32)), pa.array(ordering_keys(x, o, dims, bits, seed, center, scale)), batch.column("cls"), batch.column("q")], ["ordering", "key", "cls", "q"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(orderings, np.int64)
        for batch in batches:
            o = batch.column("ordering").to_numpy()
            begins = np.flatnonzero(np.r_[True, o[1:] != o[:-1]]) if len(o) else np.zeros(0, np.int64)
            place = np.arange(len(o)) - np.repeat(begins, np.diff(np.r_[begins, len(o)])) + seen[o]
            seen += np.bincount(o, minlength=orderings)
            yield pa.RecordBatch.from_arrays([batch.column("ordering"), batch.column("cls"), batch.column("q"), pa.array(np.full(len(o), TaskContext.get().partitionId(), np.int32)), pa.array(place)], ["ordering", "cls", "q", "part", "place"])

    curve = classes.select("cls", "v", "q").mapInArrow(tidy(keyed), "ordering int, key long, cls long, q boolean").repartitionByRange("ordering", "key", "cls").sortWithinPartitions("ordering", "key", "cls")
    curve = stored(curve.mapInArrow(tidy(placed), "ordering int, cls long, q boolean, part int, place long"), "curve")
    before = Window.partitionBy("ordering").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = curve.groupBy("ordering", "part").agg(F.count("*").alias("n")).withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ranks = stored(curve.join(stretches, ["ordering", "part"]).select("ordering", "cls", "q", (F.col("ahead") + F.col("place")).alias("rank")), "ranks")
    discard(curve)

    reach = _window(classes, ranks, k, width, kind, calibrate, target)
    block, parts = min(1 << 16, max(256, 1 << reach.bit_length())), max(1, n // part_rows)
    around = -(-reach // block)
    at = F.floor(F.col("rank") / block)
    members = ranks.select("ordering", at.alias("block"), "cls", "rank", F.lit(False).alias("asks"))
    visits = ranks.where("q").select("ordering", F.explode(F.sequence(at - around, at + around)).alias("block"), "cls", "rank", F.lit(True).alias("asks"))
    # a block's queries go to as many rooms as keep a room's lists within bounds; its members go to each of them
    most = visits.groupBy("ordering", "block").count().agg(F.max("count")).first()[0] or 0
    list_rooms = max(1, -(-most * min(block, 2 * reach + 1) // room_ids))
    if list_rooms > 1:
        visits = visits.withColumn("room", F.pmod(F.xxhash64(F.lit(seed), "cls"), F.lit(list_rooms)).cast("int"))
        members = members.withColumn("room", F.explode(F.sequence(F.lit(0), F.lit(list_rooms - 1))))
    group = ["ordering", "block", "room"][: 2 + (list_rooms > 1)]
    lists = members.unionByName(visits).groupBy(*group).applyInArrow(_listed(parts, reach), "query long, part long, listed array<long>")
    lists = stored(lists, "candidates")
    discard(ranks)

    # a part's queries go to as many rooms as keep a room's candidates, and the queries themselves, within bounds; its vectors go to each of them
    held = F.greatest(F.sum(F.size("listed")) / part_pairs, F.count("*") * 32 / part_pairs)
    rooms = stored(lists.groupBy("part").agg(F.ceil(held).cast("int").alias("rooms")), "rooms")
    room = F.pmod(F.xxhash64(F.lit(seed), "query"), F.col("rooms")).cast("int").alias("room")
    placed_lists = lists.join(rooms, "part").select("part", room, F.col("query").alias("cls"), "listed")
    asked = placed_lists.select("part", "room", "cls").distinct().join(classes.select("cls", "v"), "cls")
    vectors_at = classes.select("cls", "least", "v").mapInArrow(tidy(_parted(parts)), "part long, cls long, least long, v binary").join(rooms, "part")
    vectors_at = vectors_at.select("part", F.explode(F.sequence(F.lit(0), F.col("rooms") - 1)).alias("room"), "cls", "least", "v", F.lit(False).alias("asks"))
    asks = lambda df: df.withColumn("asks", F.lit(True))
    both = vectors_at.unionByName(asks(asked), allowMissingColumns=True).unionByName(asks(placed_lists), allowMissingColumns=True)
    found = both.groupBy("part", "room").applyInArrow(_compared(width, kind, keep), "query long, cls long, d double")
    found = found.join(classes.select("cls", "least", "ids"), "cls")
    best = found.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("d", "least", "cls"))).where(F.col("n") <= keep)
    best = stored(best.select("query", "d", "ids"), "nearest")
    discard(lists)
    asking = usable.where("q").select("id", "k1", "k2").distinct().join(classes.select("k1", "k2", F.col("cls").alias("query")), ["k1", "k2"]).select(F.col("id").alias("query_id"), "query")
    hits = asking.join(best, "query").select("query_id", "d", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    hits = hits.groupBy("query_id", "vec_id").agg(F.min("d").alias("d"))
    hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("d", "vec_id"))).where(F.col("rank") <= k)
    return hits.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.sqrt("d").alias("score"))


def _parted(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = (mix(batch.column("cls").to_numpy().astype(np.uint64)) % U(parts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part), *batch.columns], ["part", *batch.schema.names])

    return run


def _moments(width: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, ss = 0, np.zeros(width), 0.0
        for batch in batches:
            x = _unpack(batch.column("v"), width, kind)
            n, s, ss = n + len(x), s + x.sum(0), ss + float((x**2).sum())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([s.tolist()], pa.list_(pa.float64())), pa.array([ss])], ["n", "s", "ss"])

    return run


def _window(classes: DataFrame, ranks: DataFrame, k: int, width: int, kind: str, calibrate: int, target: float) -> int:
    """Ranks that a window must reach on either side, from the true neighbours of at most ``calibrate`` queries."""
    sample = classes.where("q").orderBy(F.xxhash64(F.lit("calibrate"), "v")).limit(calibrate).select("cls", "v").collect()
    if not sample:
        return 1
    asked = np.array([r["cls"] for r in sample])
    q = np.frombuffer(b"".join(bytes(r["v"]) for r in sample), kind).reshape(-1, width).astype(np.float64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0)) for _ in q]
        for batch in batches:
            x, cls = _unpack(batch.column("v"), width, kind), batch.column("cls").to_numpy()
            rough = (x**2).sum(1)[:, None] - 2 * x @ q.T
            for i in range(len(q) if len(x) else 0):
                ids, d = _best(q[i], x, cls, k + 1, rough[:, i])
                ids, d = np.concatenate([top[i][0], ids]), np.concatenate([top[i][1], d])
                order = np.lexsort((ids, d))[: k + 1]
                top[i] = ids[order], d[order]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.full(len(t[0]), a) for a, t in zip(asked, top)])), pa.array(np.concatenate([t[0] for t in top])), pa.array(np.concatenate([t[1] for t in top]))], ["query", "cls", "d"])

    near = classes.select("cls", "v").mapInArrow(tidy(scan), "query long, cls long, d double").where("query <> cls")
    near = near.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("d", "cls"))).where(F.col("n") <= k).select("query", "cls").toArrow()
    pairs = list(zip(near.column("query").to_pylist(), near.column("cls").to_pylist()))
    if not pairs:
        return 1
    wanted = classes.sparkSession.createDataFrame([(x,) for x in sorted({y for p in pairs for y in p})], "cls long")
    at: dict[int, dict[int, int]] = {}
    for row in ranks.join(F.broadcast(wanted), "cls").collect():  # at most calibrate * (k + 1) * orderings rows
        at.setdefault(row["cls"], {})[row["ordering"]] = row["rank"]
    gaps = sorted(min(abs(at[a][o] - at[b][o]) for o in at[a]) for a, b in pairs)
    return max(1, gaps[min(len(gaps) - 1, math.ceil(target * len(gaps)) - 1)])
