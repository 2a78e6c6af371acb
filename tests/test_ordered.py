"""One key or island of very many rows: dealt to several tasks, with the same result as in one."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from aeroperf.config import MergeSpec
from aeroperf.operators import collapse, dedup, islands, ordered

ROWS = 200_000
SPEC = MergeSpec(("k",), "s", "e", order=("id",), gap_min=60.0, union_cols=("units",), filled_cols=("name", "size"), identity="id", prefer_filled="name")


@pytest.fixture(scope="module")
def hot(spark):
    """A key with all rows but a few in one island, most of them in one day; nulls, blanks, and units that are rarely new."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "100k")
    id_ = F.col("id")
    units = F.when(id_ % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("u"), (id_ % 50).cast("string"), F.lit(", "), F.lit("u"), (id_ % 3).cast("string")))
    base = spark.range(ROWS).select(
        F.when(id_ < 20, F.concat(F.lit("few"), (id_ % 3).cast("string"))).otherwise("hot").alias("k"), "id", F.expr("timestamp '2025-01-01' + make_interval(0, 0, 0, 0, 0, 0, id * 37 % 86400)").alias("s"), units.alias("units"),
        F.when(id_ % 5 == 0, F.concat(F.lit("n"), id_)).when(id_ % 5 == 1, " ").alias("name"), F.when(id_ > 1000, id_ * 0.5).alias("size"),
    )
    yield base.withColumn("e", F.when(id_ % 4 > 0, F.col("s") + F.expr("make_interval(0, 0, 0, 0, 0, 1, 0)")))
    for name in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"):
        spark.conf.unset(name)


def same(a, b):
    assert a.columns == b.columns and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_no_task_holds_the_hot_group(hot):
    rows = ordered.dealt(hot, ["k"], [F.col("s"), F.col("id")]).groupBy("k", "_chunk").count().collect()
    assert max(r["count"] for r in rows) < 0.6 * ROWS and len({r["_chunk"] for r in rows if r.k == "hot"}) > 2


def test_islands_merge_alike(hot):
    whole = islands.merged(hot, SPEC)
    parts = islands.merged(hot, replace(SPEC, split_by="hour"))
    same(whole, parts)
    assert max(r.N_MERGED for r in parts.select("N_MERGED").collect()) > ROWS - 100
    again = whole.withColumn("id", F.substring_index("MERGED_IDS", "|", 1).cast("long"))
    same(islands.merged(again, replace(SPEC, split_by="hour")), islands.merged(again, SPEC))


def test_edges_are_alike(hot):
    same(islands.edges(hot, SPEC, "id"), islands.edges(hot, replace(SPEC, split_by="hour"), "id"))


def test_keys_collapse_alike(hot):
    rows = hot.withColumn("k", F.when(F.col("id") % 1000 > 0, F.col("k")))
    args = ("k", ("s", "id"), ("units",))
    same(collapse.collapse_same_key(rows, *args), collapse.collapse_same_key(rows, *args, split=True))


def test_places_are_alike(hot):
    order = [F.col("s").desc_nulls_last(), F.col("id").asc()]
    same(dedup.numbered(hot, ("k",), order), dedup.numbered(hot, ("k",), order, split=True))


def test_places_sort_a_chunk_at_a_time(hot, monkeypatch):
    """Chunks by rows, whatever a shuffle's partitions; no chunk meets another in a later task."""
    order = [F.col("s").asc(), F.col("id").asc()]
    rows = hot.withColumn("k", F.nullif("k", F.lit("few1")))
    want = dedup.numbered(rows, ("k",), order)
    sent = ordered.places(rows, ["k"], order, "seq", most=20_000)
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and "hashpartitioning" not in plan
    assert sent.rdd.getNumPartitions() == 10
    same(sent, want)
    monkeypatch.setattr(ordered, "SENT_ROWS", 0)
    same(ordered.places(rows, ["k"], order, "seq", most=20_000), want)
