"""Islands that are merged, and keys that keep their last row, on streams: state of one's own by key, with event-time timers.

Both give a row whenever what they hold has changed, and one more when it is
closed: once the watermark says that no record to come can change it, its state
is dropped. ``amended`` turns what was given out into a table of what holds.
State lives in RocksDB (``with_state_store``), so it is bounded by disk and by
what is open, not by a task's memory.
"""

from __future__ import annotations

import json
import pickle
import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from aeroperf.config import MergeSpec
from aeroperf.functions.text import canonical_list, clean
from aeroperf.functions.time import minutes_between
from aeroperf.operators.dedup import keep_one
from aeroperf.operators.islands import _chained, _prepared

# the process that asks a processor for its state's schema sees no files added to the session: processors go by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def with_state_store(spark: SparkSession) -> Iterator[None]:
    """Streams that are started within keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def amended(changes: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Of changes written batch by batch, the last of each key by ``order`` (the batch first), without those that are gone."""
    return keep_one(changes, key, order, last=True).where("not gone").drop("gone", "closed", *order)


def _spelled(values: list[Column], **more: Column) -> Column:
    """A place in an order, and what else is known of a row, as one text: Python takes a row over value by value."""
    return F.to_json(F.struct(F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)]).alias("place"), *[c.alias(n) for n, c in more.items()]), {"ignoreNullFields": "false"})


def _place(spelled: dict) -> list[tuple]:
    """A place as it is compared: a null before any other value."""
    return [(v is not None, 0 if v is None else v) for v in spelled.values()]


#: What is held of a key, pickled: values come out as they went in, whatever their types, in one message to the store and one row of it.
HELD = T.StructType([T.StructField("held", T.BinaryType())])


class _Islands(StatefulProcessor):
    """Open islands of a key, in order of time: each with its ends, unions, first filled values and records with their places.

    A key has one timer, for the first of its islands that is due; it is put
    off when that one has grown, and set forward when an earlier one comes.
    """

    def __init__(self, unions: tuple[str, ...], filled: tuple[str, ...], gap_us: int, out: T.StructType, keys: int):
        self.unions, self.filled, self.gap_us, self.row, self.blanks = unions, filled, gap_us, Row(*out.names), len(out.names) - keys - 3

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.open = handle, handle.getValueState("open", HELD)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        islands, timer = self._held()
        starts, ends = [x["s"] for x in islands], [x["e"] for x in islands]
        gone, touched = set(), set()
        for r in rows:
            new = self._single(r)
            # islands are further apart than the gap: those near the new one follow one another
            at = slice(bisect_left(ends, new["s"] - self.gap_us), bisect_right(starts, new["e"] + self.gap_us))
            near = islands[at]
            if near:
                kept = min(near, key=lambda x: (x["s"], x["id"]))["id"]
                gone.update(x["id"] for x in near if x["id"] != kept)
                for x in near:
                    new = self._merged(x, new)
                new["id"] = kept
            islands[at], starts[at], ends[at] = [new], [new["s"]], [new["e"]]
            touched.add(new["id"])
        self._hold(islands, timer)
        for x in islands:
            if x["id"] in touched and x["id"] not in gone:
                yield self._given(key, x, False)
        for i in sorted(gone):
            yield self.row(*key, *[None] * self.blanks, i, False, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        islands, timer = self._held()
        fired = expiredTimerInfo.getExpiryTimeInMs()
        self._hold([x for x in islands if self._due(x) > now], None if timer == fired else timer)
        for x in islands:
            if self._due(x) <= now:
                yield self._given(key, x, True)

    def close(self) -> None:
        pass

    def _due(self, island: dict) -> int:
        """The watermark at which no record to come starts within the gap."""
        return (island["e"] + self.gap_us) // 1000 + 1

    def _held(self) -> tuple[list[dict], int | None]:
        held = self.open.get()
        return pickle.loads(held[0]) if held else ([], None)

    def _hold(self, islands: list[dict], timer: int | None) -> None:
        due = self._due(islands[0]) if islands else None
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if due is not None and timer != due:
            self.handle.registerTimer(due)
        if islands:
            self.open.update((pickle.dumps((islands, due), 5),))
        else:
            self.open.clear()

    def _single(self, r: Row) -> dict:
        x = json.loads(r["row__"])
        s, e, name, place = x["s"], x["e"], x["id"], _place(x["place"])
        new = {"id": name, "s": s, "e": e, "n": 1, "zero": s == e, "ids": [(place, name)]}
        for i, c in enumerate(self.unions):
            new[c] = x[f"list{i}"].split("|") if x[f"list{i}"] else []
        for i, c in enumerate(self.filled):
            new[c], new[f"{c}_at"] = (r[c], place) if x[f"has{i}"] else (None, None)
        return new

    def _merged(self, a: dict, b: dict) -> dict:
        out = {"id": a["id"], "s": min(a["s"], b["s"]), "e": max(a["e"], b["e"]), "n": a["n"] + b["n"], "zero": a["zero"] and b["zero"], "ids": a["ids"]}
        out["ids"].extend(b["ids"])  # a's own list goes on: one record more costs no copy of those before
        for c in self.unions:
            out[c] = a[c] if a[c] == b[c] else sorted({*a[c], *b[c]})
        for c in self.filled:
            first = min((x for x in (a, b) if x[f"{c}_at"] is not None), key=lambda x: x[f"{c}_at"], default=a)
            out[c], out[f"{c}_at"] = first[c], first[f"{c}_at"]
        return out

    def _given(self, key, x: dict, closed: bool) -> Row:
        lists = ["|".join(sorted(x[c])) or None for c in self.unions]
        x["ids"].sort(key=lambda r: r[0])
        return self.row(*key, x["s"], x["e"], *lists, *[x[c] for c in self.filled], x["n"], "|".join(i for _, i in x["ids"]), x["zero"] if x["n"] > 1 else None, x["id"], closed, False)


def merged_islands(events: DataFrame, spec: MergeSpec, late: str) -> DataFrame:
    """``islands.merged`` of a stream: key, start, end, unions, first filled values, N_MERGED, MERGED_IDS, ZERO_SPAN_ONLY, SPAN_MIN, and island_id, closed, gone.

    A late record, up to ``late`` behind the newest start, joins its island,
    also where it bridges two: one goes on, the other is given out as gone.
    ``spec.identity`` is needed; island_id is that of a record. Rows without a
    start, or with a null in the key, are not chained and not given out; records
    later than ``late`` are dropped, as Spark does. Order columns are compared
    as numbers or text. Start it with ``with_state_store``, in update mode.
    """
    kinds = dict(zip(events.columns, (f.dataType for f in events.schema.fields)))
    rows = _prepared(events.where(_chained(spec)), spec)
    blank = clean(F.col(spec.prefer_filled).cast("string")).isNull() if spec.prefer_filled else F.lit(False)
    plain = lambda c: F.col(c) if isinstance(kinds[c], T.NumericType) else F.col(c).cast("string")
    known = {"s": F.unix_micros("_s"), "e": F.unix_micros("_e"), "id": F.col(spec.identity).cast("string")}
    known |= {f"list{i}": canonical_list(F.col(c)) for i, c in enumerate(spec.union_cols)}
    known |= {f"has{i}": clean(F.col(c).cast("string")).isNotNull() for i, c in enumerate(spec.filled_cols)}
    row = _spelled([blank, F.col("_s") == F.col("_e"), F.unix_micros("_s"), *map(plain, spec.order)], **known)
    rows = rows.withColumn("t__", F.col("_s").cast("timestamp")).withWatermark("t__", late).select(*spec.key, "t__", row.alias("row__"), *spec.filled_cols)
    text, long, flag = T.StringType(), T.LongType(), T.BooleanType()
    out = [*[(c, kinds[c]) for c in spec.key], ("s__", long), ("e__", long), *[(c, text) for c in spec.union_cols], *[(c, kinds[c]) for c in spec.filled_cols]]
    out += [("N_MERGED", long), ("MERGED_IDS", text), ("ZERO_SPAN_ONLY", flag), ("island_id", text), ("closed", flag), ("gone", flag)]
    given = T.StructType([T.StructField(*f) for f in out])
    processor = _Islands(spec.union_cols, spec.filled_cols, round(spec.gap_min * 60e6), given, len(spec.key))
    got = rows.groupBy(*spec.key).transformWithState(processor, given, "Update", "EventTime")
    ends = got.withColumns({spec.start: F.timestamp_micros("s__"), spec.end: F.timestamp_micros("e__")})
    ends = ends.withColumn("SPAN_MIN", minutes_between(F.col(spec.end), F.col(spec.start)))
    return ends.select(*spec.key, spec.start, spec.end, *spec.union_cols, *spec.filled_cols, "N_MERGED", "MERGED_IDS", "ZERO_SPAN_ONLY", "SPAN_MIN", "island_id", "closed", "gone")


class _Last(StatefulProcessor):
    """The last row of a key so far, by an order; its place in it, and until when it is held. A timer that a later row has put off is set anew when it fires."""

    def __init__(self, rest: tuple[str, ...], out: T.StructType, late_ms: int):
        self.rest, self.row, self.late_ms = rest, Row(*out.names), late_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", HELD)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.last.get()
        before, best, until = pickle.loads(held[0]) if held else (None, None, 0)
        place, first = before, until
        for r in rows:
            x = json.loads(r["row__"])
            until = until if x["ms"] is None else max(until, x["ms"] + self.late_ms)
            new = _place(x["place"])
            if place is None or new > place:
                place, best = new, r
        if place is not before:
            best = tuple(best[c] for c in self.rest)
        if place is not before or until != first:
            self.last.update((pickle.dumps((place, best, until), 5),))
        if until and not first:  # a key without a stamp stays until it has one
            self.handle.registerTimer(until + 1)
        if place is not before:
            yield self.row(*key, *best, False, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.last.get()
        if held:
            _, best, until = pickle.loads(held[0])
            if until < timerValues.getCurrentWatermarkInMs():
                self.last.clear()
                yield self.row(*key, *best, True, False)
            else:
                self.handle.registerTimer(until + 1)

    def close(self) -> None:
        pass


def _leading(table: pa.Table, key: tuple[str, ...], order: list[str], stamp: str) -> pa.Table:
    """Rows of which no row of the same key is both later by ``order`` and at least as late by ``stamp``; of equal rows the first. Null stamps among themselves.

    Whatever a watermark leaves out, the last of the rest is among them, and so
    is the newest stamp.
    """
    n = len(table)
    group = pc.is_null(table.column(stamp)).to_numpy().astype(np.int64)
    for c in key:
        codes = pc.dictionary_encode(table.column(c).combine_chunks(), null_encoding="encode").indices.to_numpy()
        group = np.unique(group * (int(codes.max()) + 1) + codes, return_inverse=True)[1]
    place = np.empty(n, np.int64)
    by = table.select(order).append_column("came__", pa.array(np.arange(n)))
    place[pc.sort_indices(by, [*[(c, "ascending") for c in order], ("came__", "descending")], null_placement="at_start").to_numpy()] = np.arange(n)
    at = np.lexsort((-place, group))  # each key's rows, the last first
    stamps = np.unique(pc.fill_null(table.column(stamp), 0).to_numpy(), return_inverse=True)[1]
    newest = np.maximum.accumulate(group[at] * n + stamps[at])
    return table.take(pa.array(np.sort(at[np.r_[True, newest[1:] > newest[:-1]]])))


def _combined(key: tuple[str, ...], order: list[str], stamp: str, max_rows: int, max_bytes: int):
    """``_leading`` rows of a partition; so many rows and bytes are held at most, and go out as they are where that leaves too many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for batch in batches:
            if len(batch):
                held, rows, size = [*held, batch], rows + len(batch), size + batch.nbytes
            if rows >= max_rows or size >= max_bytes:
                held = _leading(pa.Table.from_batches(held), key, order, stamp).combine_chunks().to_batches()
                rows, size = sum(map(len, held)), sum(b.nbytes for b in held)
                if 2 * rows >= max_rows or 2 * size >= max_bytes:
                    yield from held
                    held, rows, size = [], 0, 0
        if held:
            yield from _leading(pa.Table.from_batches(held), key, order, stamp).to_batches()

    return run


def keep_last(events: DataFrame, key: tuple[str, ...], ts: str, order: tuple[str, ...], late: str, late_ms: int) -> DataFrame:
    """``keep_one(last=True)`` of a stream: the last row of each key by ``order``, whenever it has changed, with closed and gone (never).

    A key's state is dropped, and its row given out as closed, once the
    watermark is ``late_ms`` past its newest ``ts``; a row that comes after
    that opens the key anew, and ``amended`` still keeps the later one. Order
    columns are numbers or text (stamps as text sort like stamps), nulls first;
    of rows equal in ``order`` the first to come stays. Null keys are one key.
    Start it with ``with_state_store``, in update mode. Before they meet the
    state, a batch's rows are gathered by key and those that can't be the last
    are left out, whole Arrow batches at a time.
    """
    kinds = {f.name: f.dataType for f in events.schema.fields}
    rest = [c for c in events.columns if c not in key]
    plain = lambda c: F.col(c) if isinstance(kinds[c], T.NumericType) else F.col(c).cast("string")
    stamp = F.col(ts).cast("timestamp")
    rows, places = events, [f"place{i}__" for i in range(len(order))]
    if not any(isinstance(kinds[c], (T.StructType, T.ArrayType)) for c in key):  # Arrow has no codes for nested keys
        placed = events.withColumns({p: plain(c) for p, c in zip(places, order)} | {"us__": F.unix_micros(stamp)})
        rows = placed.repartition(*map(F.col, key)).mapInArrow(_combined(key, places, "us__", 1 << 18, 1 << 26), placed.schema).select(events.columns)
    rows = rows.withColumn("row__", _spelled([plain(c) for c in order], ms=F.unix_millis(stamp)))
    rows = rows.withWatermark(ts, late) if isinstance(kinds[ts], T.TimestampType) else rows.withColumn("t__", stamp).withWatermark("t__", late)
    out = [*[(c, kinds[c]) for c in (*key, *rest)], ("closed", T.BooleanType()), ("gone", T.BooleanType())]
    given = T.StructType([T.StructField(*f) for f in out])
    return rows.groupBy(*key).transformWithState(_Last(tuple(rest), given, late_ms), given, "Update", "EventTime")
