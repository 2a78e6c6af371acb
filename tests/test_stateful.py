"""Streams with state of their own against the batch operators: late records, bridges, closing, restarts."""

import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aeroperf.config import MergeSpec
from aeroperf.operators.dedup import keep_one
from aeroperf.operators.islands import merged
from aeroperf.streaming import stateful

SPEC = MergeSpec(("k",), "s", "e", order=("id",), gap_min=60.0, union_cols=("units",), filled_cols=("name", "size"), identity="id", prefer_filled="name")
SCHEMA = "k string, id long, s timestamp, e timestamp, units string, name string, size double"
T0 = datetime(2025, 1, 1)


def flights(seed, n=120):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        s = T0 + timedelta(minutes=rng.randint(0, 2_000))
        e = rng.choice([None, s, s + timedelta(minutes=rng.randint(0, 90)), s - timedelta(minutes=5)])
        out.append((rng.choice(["a", "b", None]), i, s, e, rng.choice([None, "", "x|y", "y, z"]), rng.choice([None, " ", "N1", "N2"]), rng.choice([None, 1.5, 2.5])))
    return out


def run(spark, tmp_path, parts, schema, apply, name):
    """Feed the parts one by one, each in a query of its own that goes on from the checkpoint; all changes."""
    src, out, mark = (f"{tmp_path}/{name}-{x}" for x in ("src", "out", "mark"))

    def write(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(out)

    with stateful.with_state_store(spark):
        for part in parts:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
            stream = apply(spark.readStream.schema(schema).parquet(src))
            stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def plain(df, cols):
    return sorted(df.select(cols).collect(), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_islands_equal_the_batch(spark, tmp_path, seed):
    rows = flights(seed)
    want = merged(spark.createDataFrame([r for r in rows if r[0] is not None], SCHEMA), SPEC)
    random.Random(seed).shuffle(rows)  # every record is late to some island
    changes = run(spark, tmp_path, [rows[i::4] for i in range(4)], SCHEMA, lambda e: stateful.merged_islands(e, SPEC, "3 days"), "i")
    got = stateful.amended(changes, ("k", "island_id"), ("batch",))
    assert plain(got, want.columns) == plain(want, want.columns)
    assert changes.where("gone").count() > 0


def test_islands_close_and_their_state_goes(spark, tmp_path):
    at = lambda m: T0 + timedelta(minutes=m)
    row = lambda i, m: ("a", i, at(m), at(m + 10), "x", "N", 1.0)
    parts = [[row(1, 0), row(2, 30)], [row(3, 1_000)], [row(4, 20)], [row(5, 2_000)], [row(6, 2_010)]]
    changes = run(spark, tmp_path, parts, SCHEMA, lambda e: stateful.merged_islands(e, SPEC, "100 minutes"), "c")
    closed = sorted((r.MERGED_IDS, r.N_MERGED) for r in changes.where("closed").collect())
    assert closed == [("1|2", 2), ("3", 1)]  # the record of minute 20 came later than allowed, and was dropped
    got = stateful.amended(changes, ("k", "island_id"), ("batch",))
    assert sorted(r.MERGED_IDS for r in got.collect()) == ["1|2", "3", "5|6"]


def test_keep_last_equals_the_batch(spark, tmp_path):
    rng = random.Random(7)
    schema = "k string, ts timestamp, seq long, note string, v int"
    rows = [(rng.choice(["a", "b", "c", None]), T0 + timedelta(minutes=rng.randint(0, 50)), rng.choice([None, 1, 2, 10]), rng.choice([None, "x", "y"]), i) for i in range(80)]
    order = ("seq", "note", "ts", "v")
    changes = run(spark, tmp_path, [rows[i::4] for i in range(4)], schema, lambda e: stateful.keep_last(e, ("k",), "ts", order, "1 day", 86_400_000), "k")
    got = stateful.amended(changes, ("k",), ("batch",))
    want = keep_one(spark.createDataFrame(rows, schema), ("k",), order, last=True)
    assert plain(got, want.columns) == plain(want, want.columns)


def test_a_key_is_dropped_and_comes_again(spark, tmp_path):
    schema = "k string, ts timestamp, v int"
    at = lambda m: T0 + timedelta(minutes=m)
    parts = [[("a", at(0), 1), ("a", at(1), 5)], [("b", at(100), 1)], [("b", at(101), 2)], [("a", at(102), 3)]]
    changes = run(spark, tmp_path, parts, schema, lambda e: stateful.keep_last(e, ("k",), "ts", ("v",), "10 minutes", 600_000), "d")
    assert [(r.k, r.v) for r in changes.where("closed").collect()] == [("a", 5)]
    assert [r.v for r in changes.where("k = 'a' AND not closed").orderBy("batch").collect()] == [5, 3]
    got = stateful.amended(changes, ("k",), ("v", "batch"))
    assert {(r.k) for r in got.collect()} == {"a", "b"}


def timers(spark, tmp_path, parts, schema, apply):
    """Timers that each batch sets."""
    src, mark, out = (f"{tmp_path}/timers-{x}" for x in ("src", "mark", "out"))
    got = []
    with stateful.with_state_store(spark):
        for part in parts:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
            stream = apply(spark.readStream.schema(schema).parquet(src)).writeStream.foreachBatch(lambda batch, _: batch.write.mode("append").parquet(out)).outputMode("update").option("checkpointLocation", mark).trigger(availableNow=True).start()
            stream.awaitTermination()
            got.append(sum(x["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for x in stream.recentProgress if x["numInputRows"]))
    return got


def test_a_key_has_one_timer_for_all_its_islands(spark, tmp_path):
    parts = [[("a", 100 * p + i, T0 + timedelta(hours=3 * i + p), None, "x", "N", 1.0) for i in range(40)] for p in range(2)]
    assert timers(spark, tmp_path, parts, SCHEMA, lambda e: stateful.merged_islands(e, SPEC, "900 days")) == [1, 1]


def test_a_key_that_goes_on_sets_no_timer(spark, tmp_path):
    schema = "k string, ts timestamp, v int"
    parts = [[("a", None if p == 0 else T0 + timedelta(minutes=p), p), ("b", T0 + timedelta(minutes=p), p)] for p in range(3)]
    assert timers(spark, tmp_path, parts, schema, lambda e: stateful.keep_last(e, ("k",), "ts", ("ts",), "9 days", 777_600_000)) == [1, 1, 0]


@pytest.mark.parametrize("most", [8, 1_000])
def test_rows_that_cannot_be_the_last_are_left_out_whatever_the_watermark(most):
    rng = random.Random(most)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["x", None]), rng.choice([None, 1, 2, 3]), rng.choice([None, "p", "q"]), rng.choice([None, *range(6)]), i) for i in range(400)]
    names = ["k", "l", "o", "p", "us", "i"]
    batches = pa.table([pa.array(c) for c in zip(*rows)], names=names).to_batches(max_chunksize=5)
    got = [tuple(r.values()) for b in stateful._combined(("k", "l"), ["o", "p"], "us", most, 1 << 20)(iter(batches)) for r in b.to_pylist()]
    assert len(set(got)) == len(got) and set(got) <= set(rows) and len(got) < (80 if most == 1_000 else 400)
    place = lambda r: (r[2] is not None, r[2] or 0, r[3] is not None, r[3] or "", -r[5])
    for mark in range(7):
        last = lambda x: {k: max((r for r in x if r[:2] == k and (r[4] is None or r[4] >= mark)), key=place, default=None) for k in {r[:2] for r in rows}}  # noqa: E731, B023
        assert last(got) == last(rows)
    newest = lambda x: {k: max((r[4] for r in x if r[:2] == k and r[4] is not None), default=None) for k in {r[:2] for r in rows}}
    assert newest(got) == newest(rows)
