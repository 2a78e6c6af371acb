"""Stored counts, footers, line numbers, accounting on the way, and sides stored by key: equal to the plain way, and cheaper in the way they promise."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aeroperf.config import KpiSpec
from aeroperf.operators import kpi, reconcile
from aeroperf.operators.refstate import ReferenceState
from aeroperf.operators.sides import StoredSides
from aeroperf.plans import flights
from aeroperf.sources import catalog, delimited

SPEC = KpiSpec(("k",), "v", "d", cap=50.0, p=0.2, min_n=2, window_col="at")


def samples(spark, shift=0.0):
    t0 = datetime(2024, 12, 20)
    rows = [("ab"[i % 2] if i % 9 else None, float(i * 7 % 60) + shift, t0 + timedelta(hours=11 * i)) for i in range(200)]
    return spark.createDataFrame([*rows, ("a", 3.0, None), ("c", 1.0, t0)], "k string, v double, at timestamp")


def refs(df):
    return sorted((r.k, r.n, r.reference) for r in df.collect())


def test_references_from_counts_equal_those_from_rows(spark, tmp_path):
    from dataclasses import replace

    rows, state = samples(spark), ReferenceState(spark, str(tmp_path / "s"), SPEC)
    months = [(2024, 12), (2025, 1), (2025, 2), (2025, 3), (2025, 4)]
    assert state.reference() is None and state.update(rows, months) == 0
    for window in (("2024-12-25 00:00:00", "2025-01-09 23:59:59"), ("2025-01-01 00:00:00", "2025-01-31 23:59:59"), ("2020-01-01 00:00:00", "2030-01-01 23:59:59")):
        assert refs(state.reference(window)) == refs(kpi.reference(rows, replace(SPEC, window=window))) != []
    assert refs(state.reference()) == refs(kpi.reference(rows.where("at IS NOT NULL"), SPEC))
    january = (F.year("at") == 2025) & (F.month("at") == 1)
    state.update(samples(spark, 5.0).where(january), [(2025, 1)])
    assert refs(state.reference()) == refs(kpi.reference(rows.where(~january).union(samples(spark, 5.0).where(january)).where("at IS NOT NULL"), SPEC))
    assert refs(state.reference(version=0)) == refs(kpi.reference(rows.where("at IS NOT NULL"), SPEC))
    plan = state.counts(("2025-01-03 00:00:00", "2025-01-05 23:59:59"))
    assert len({f for f in plan.inputFiles() if "month=1/" in f}) >= 1 and "PartitionFilters: [" in plan._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="whole days"):
        state.reference(("2025-01-03 10:00:00", "2025-01-05 23:59:59"))
    with pytest.raises(ValueError, match="month=3"):
        state.update(rows, months[:-2])


def test_footers_equal_the_scan(spark, tmp_path):
    kind = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(kind)
    t0 = datetime(1965, 1, 1, 1, 2, 3, 456789)
    rows = spark.createDataFrame([(i, t0 + timedelta(hours=i * 1000, microseconds=i)) for i in range(1000)] + [(i, None) for i in range(5)], "i long, ts timestamp")
    for stored, some in (("TIMESTAMP_MICROS", rows.repartition(4)), ("TIMESTAMP_MILLIS", rows.where("i % 3 = 0").coalesce(1)), ("INT96", rows.where("i % 2 = 0").coalesce(1)), ("TIMESTAMP_MICROS", rows.where("ts IS NULL").coalesce(1)), ("TIMESTAMP_MICROS", rows.where("false").coalesce(1))):
        spark.conf.set(kind, stored)
        some.write.mode("append").parquet(str(tmp_path / "t"))
    spark.conf.set(kind, before)
    rows.where("i > 500").withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(str(tmp_path / "n"))
    for folder, n in (("t", 1), ("n", 0)):
        path = str(tmp_path / folder)
        got = catalog.footers(spark, path, "ts").collect()
        scan = {r.file: r for r in catalog.inventory(spark, spark.read.parquet(path), path, "ts").collect()}
        for r in got:
            s = scan[r.path.rsplit("/", 1)[1]]
            assert (r.rows, str(r.first), str(r.last), r.size) == (s.rows or 0, str(s.first), str(s.last), s.size)
        assert sum(r.scanned for r in got) == n and len(got) == len([x for x in scan if x.endswith(".parquet")])


def test_one_number_over_all_files_however_they_are_split(spark, tmp_path):
    at = 0
    for name, n in (("b", 3_000), ("a", 5_000), ("c", 0), ("d", 1)):
        (tmp_path / f"{name}.csv").write_text("n;x\n" + "".join(f"{name}{i};{'y' * (i % 50)}\n" for i in range(n)))
    want = [f"{name}{i}" for name, n in (("a", 5_000), ("b", 3_000), ("d", 1)) for i in range(n)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("9000", before):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        df = delimited.read_delimited(spark, str(tmp_path), ["n", "x"], with_origin=True)
        got = delimited.numbered_lines(df).select("line", "n").orderBy("line").collect()
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert [r.n for r in got] == want and [r.line for r in got] == list(range(1, len(want) + 1))
        at += 1


def test_steps_are_counted_by_the_job_that_uses_the_frame(spark):
    rows = [(f"K{i // 2}", "A", "X", "Y", datetime(2025, 1, 1) + timedelta(minutes=20 * (i % 40)), None) for i in range(60)] + [(None, "A", "X", "Y", None, None)]
    df = spark.createDataFrame(rows, "pk string, co_indicativo string, co_addep string, co_addes string, dh_inicio timestamp, dh_fim timestamp")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("steps", "")
    counted = flights.prepared_with_steps(df)
    assert len(tracker.getJobIdsForGroup("steps")) == 0
    out = counted.frame.collect()
    jobs = len(tracker.getJobIdsForGroup("steps"))
    steps = counted.steps
    assert len(tracker.getJobIdsForGroup("steps")) == jobs
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert steps == {"read": 61, "collapsed": 30, "kept": 31, "merged": 31 - len(out), "out": len(out)}


def test_sides_join_without_an_exchange(spark):
    left = spark.createDataFrame([(i if i % 7 else None, "p" if i % 3 else None, i) for i in range(300)], "a long, b string, v long")
    right = spark.createDataFrame([(i if i % 5 else None, "p" if i % 2 else None, i * 2) for i in range(0, 400, 2)], "a long, b string, v long")
    both, key = StoredSides(left, right, ("a", "b"), buckets=4), ("a", "b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = lambda df: sorted(map(repr, df.collect()))
        assert rows(both.only("left")) == rows(reconcile.only_left(left, right, key)) and rows(both.only("right")) == rows(reconcile.only_left(right, left, key))
        assert rows(both.shared()) == rows(reconcile.shared(left, right, key))
        whole = lambda df: df.where("a IS NOT NULL AND b IS NOT NULL")
        pairs = both.paired(("v",), ("v",))
        assert rows(whole(pairs)) == rows(reconcile.paired(whole(left), whole(right), key, ("v",), ("v",))) and pairs.where("a IS NULL").count() > 0
        assert both.diff().first() == reconcile.keyed_diff(left, right, key).first()
        for df, n in ((both.only("left"), 0), (both.shared(), 0), (pairs, 0), (both.diff(), 1)):
            df.collect()
            assert len(re.findall(r"Exchange ", df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0])) <= n
        plain = reconcile.only_left(left, right, key)
        plain.collect()
        assert "Exchange hashpartitioning" in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    files = both.left.inputFiles()
    both.drop()
    import os

    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
