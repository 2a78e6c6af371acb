"""The snapshot table: a writer that dies at any step, readers of a version, writers that meet, and the tables built on it."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from aeroperf.sinks.incremental import DailyTable, IncrementalTable
from aeroperf.sinks.snapshot import SnapshotTable
from aeroperf.sources import rest


class Killed(Exception):
    pass


def month(spark, m, *values):
    return spark.createDataFrame([(m, v) for v in values], "m int, v string")


def held(df):
    return None if df is None else sorted((r.m, r.v) for r in df.collect())


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("step", ["_write", "_measured", "_stage", "_rename"])
def test_a_writer_that_dies_leaves_the_old_version_or_the_new_one(spark, tmp_path, monkeypatch, step, when):
    table = SnapshotTable(spark, f"file://{tmp_path}/t", ("m",))
    count = {"n": F.count("*")}
    table.replace(month(spark, 1, "old").union(month(spark, 2, "kept")), [(1,), (2,)], count)
    before = table.read()
    real = getattr(SnapshotTable, step)

    def dies(self, *args):
        if when == "before":
            raise Killed
        real(self, *args)
        raise Killed

    monkeypatch.setattr(SnapshotTable, step, dies)
    with pytest.raises(Killed):
        table.replace(month(spark, 1, "new", "newer").union(month(spark, 3, "more")), [(1,), (3,)], count)
    monkeypatch.undo()
    done = (step, when) == ("_rename", "after")
    old, new = [(1, "old"), (2, "kept")], [(1, "new"), (1, "newer"), (2, "kept"), (3, "more")]
    again = SnapshotTable(spark, f"file://{tmp_path}/t", ("m",))  # another reader
    assert held(again.read()) == (new if done else old) and again.versions() == ([0, 1] if done else [0])
    assert {n["m"]: n["n"] for n in again.notes()} == ({1: 2, 2: 1, 3: 1} if done else {1: 1, 2: 1})
    assert held(before) == old == held(again.read(0))
    again.replace(month(spark, 1, "last"), [(1,), (3,)], count)
    assert held(again.read()) == [(1, "last"), (2, "kept")] and {n["m"]: n["n"] for n in again.notes()} == {1: 1, 2: 1} | {3: 0}
    again.vacuum(keep=1, older_than_s=0)
    assert held(again.read()) == [(1, "last"), (2, "kept")] and len(list((tmp_path / "t" / "data").iterdir())) == 2 and len(again.versions()) == 1


def test_of_two_writers_the_later_puts_its_months_on_top(spark, tmp_path, monkeypatch):
    a, b = (SnapshotTable(spark, f"file://{tmp_path}/t", ("m",)) for _ in range(2))
    real = SnapshotTable._stage

    def meets(self, state):
        monkeypatch.undo()
        b.replace(month(spark, 2, "b"), [(2,)])  # takes the version that the other is about to publish
        return real(self, state)

    monkeypatch.setattr(SnapshotTable, "_stage", meets)
    assert a.replace(month(spark, 1, "a"), [(1,)]) == 1
    assert held(a.read()) == [(1, "a"), (2, "b")] and held(a.read(0)) == [(2, "b")]
    assert [(r.version, r.replaced, r.live) for r in a.history().orderBy("version").collect()] == [(0, 1, 1), (1, 1, 2)]


def test_a_batch_comes_in_once(spark, tmp_path):
    t = SnapshotTable(spark, f"file://{tmp_path}/t", ("m",))
    assert t.read() is None and t.versions() == []
    for number, value in ((0, "first"), (0, "repeated"), (1, "second")):
        t.replace(month(spark, 1, value), [(1,)], batch=("s", number))
    assert held(t.read()) == [(1, "second")] and held(t.read(0)) == [(1, "first")] and t.versions() == [0, 1]
    with pytest.raises(ValueError, match="m=9"):
        t.replace(month(spark, 9, "x"), [(1,)])
    with pytest.raises(ValueError, match="HIVE_DEFAULT"):
        t.replace(month(spark, None, "x"), [(1,)])
    assert t.versions() == [0, 1] and len(list((tmp_path / "t" / "data").iterdir())) == 2


def test_a_month_stored_four_times_on_one_day_says_the_last_count(spark, tmp_path):
    t = IncrementalTable(spark, str(tmp_path / "t"), "ts")
    for n in (31, 3, 20, 5):
        rows = spark.range(n).select("id", F.expr("timestamp '2025-01-01' + make_interval(0, 0, 0, int(id))").alias("ts"))
        t.store(rows, [(2025, 1)], "2025-02-03")
        assert [(r.n, r.days) for r in t.manifest().collect()] == [(n, n)] and t.rows().count() == n
    assert t.rows(1).count() == 3 and [r.n for r in t.manifest(2).collect()] == [20]


def test_a_day_that_was_full_and_then_empty_says_so(spark, tmp_path):
    t = DailyTable(spark, str(tmp_path / "d"))
    days = lambda *lines: spark.createDataFrame(lines, "day string, n long, status string, error string")
    rows = lambda n: spark.range(n).select(F.lit("2025-01-01").alias("_day"), F.col("id").alias("v"))
    t.store(rows(10), days(("2025-01-01", 10, "ok", None)), "2025-01-01")
    t.store(rows(0), days(("2025-01-01", 0, "empty", None)), "2025-01-01")
    assert t.rows() is None and [(r.n, r.status) for r in t.manifest().collect()] == [(0, "empty")]
    t.store(rows(4), days(("2025-01-01", 4, "ok", None)), "2025-01-02")
    t.store(rows(0), days(("2025-01-01", 0, "failed", "gone")), "2025-01-02")
    assert t.rows().count() == 4 and [(r.status, r.error) for r in t.manifest().collect()] == [("failed", "gone")]
    assert t.pending(date(2025, 1, 1), date(2025, 1, 1)) == [date(2025, 1, 1)]


def test_paging_needs_a_total_order(spark, tmp_path):
    """25 rows of one day in pages of 10 from a server that breaks ties freely."""
    import json

    (tmp_path / "f.json").write_text(json.dumps([{"d": "2025-01-10", "id": i} for i in range(25)]))
    spark.dataSource.register(rest.RestSource)
    options = {"base": str(tmp_path), "table": "f", "column": "d", "start": "2025-01-01", "end": "2025-02-01", "fetch": "tests.rest_server:folder_fetch"}
    read = lambda **o: spark.read.format("rest").schema("id string, d string").options(**options, **o).load()
    with pytest.raises(Exception, match="more than one page"):
        read(pagerows="10").collect()
    assert read(pagerows="30").count() == 25
    for said in ({"identity": "id"}, {"order": "d,id"}):
        got = read(pagerows="10", count="tests.rest_server:folder_count", **said).collect()
        assert sorted(int(r.id) for r in got) == list(range(25))
    with pytest.raises(Exception, match="the server counts 26"):
        read(pagerows="10", identity="id", count="tests.rest_server:count_of_more").collect()


def test_fetched_days_are_written_once(spark, tmp_path):
    import json
    from pathlib import Path

    (tmp_path / "t.json").write_text(json.dumps([{"d": "2025-01-01T10", "v": i} for i in range(25)]))
    ask = lambda **more: rest.fetch_days(spark, [date(2025, 1, 1), date(2025, 1, 2)], str(tmp_path), "t", "d", "v string", "tests.rest_server:folder_fetch", tries=1, **more)
    got = ask(identity=("v",), count="tests.rest_server:folder_count")
    (tmp_path / "t.json").write_text("[]")  # what the server has now changes nothing
    assert got.rows.count() == 25 and {(r.day, r.n, r.status) for r in got.days.collect()} == {("2025-01-01", 25, "ok"), ("2025-01-02", 0, "empty")}
    folder = Path(got.rows.inputFiles()[0].removeprefix("file://")).parent
    got.discard()
    assert not folder.exists()


def test_stamps_before_the_table(spark, tmp_path):
    t = IncrementalTable(spark, str(tmp_path / "t"), "ts", ("k",), ("v",))
    rows = spark.createDataFrame([("a", datetime(2025, 1, 1), 1), ("a", datetime(2025, 1, 2), 2), (None, datetime(2025, 1, 3), 3), (None, datetime(2025, 1, 3), 3)], "k string, ts timestamp, v int")
    assert t.store(rows, [(2025, 1), (2025, 2)], "2025-03-01") == 0
    assert sorted(r.v for r in t.rows().collect()) == [2, 3, 3] and {(r.month, r.n) for r in t.manifest().collect()} == {(1, 3), (2, 0)}
    with pytest.raises(ValueError):
        t.store(spark.createDataFrame([("a", None, 1)], "k string, ts timestamp, v int"), [(2025, 1)], "2025-03-01")
    assert t.table.versions() == [0]
