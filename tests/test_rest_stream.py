"""The REST source as a stream: restarts, days that are still open, batches that die before or after they are published."""

import json

import pytest

from aeroperf.sinks.incremental import DailyTable
from aeroperf.sinks.snapshot import SnapshotTable
from aeroperf.sources import rest


class Server:
    def __init__(self, spark, tmp_path, **options):
        self.spark, self.path = spark, tmp_path
        spark.dataSource.register(rest.RestSource)
        self.table = DailyTable(spark, f"file://{tmp_path}/table")
        self.options = {"base": str(tmp_path), "table": "f", "column": "d", "start": "2025-01-01", "identity": "id", "pagerows": "10", "fetch": "tests.rest_server:folder_fetch", "count": "tests.rest_server:folder_count", "clock": "tests.rest_server:clock", "tries": "1"} | options

    def has(self, now, **days):
        rows = [{"d": f"2025-01-{day[1:]}T10:00", "id": f"{day}-{i}-{v}"} for day, (n, v) in days.items() for i in range(n)]
        (self.path / "f.json").write_text(json.dumps(rows))
        (self.path / "clock").write_text(now)

    def run(self):
        stream = self.spark.readStream.format("rest").schema("_day string, _end boolean, id string").options(**self.options).load()
        self.table.follow(stream, f"file://{self.path}/mark", lambda: "now").trigger(availableNow=True).start().awaitTermination()

    def held(self):
        out = {}
        for r in self.table.rows().collect():
            out.setdefault(str(r.day)[-2:], []).append(r.id)
        assert all(len(set(x)) == len(x) for x in out.values())
        return {day: (len(ids), ids[0].split("-")[2]) for day, ids in sorted(out.items())}


def test_restarts_lose_and_repeat_no_row(spark, tmp_path):
    server = Server(spark, tmp_path)
    server.has("2025-01-02T10:00", d01=(25, "a"), d02=(5, "a"))
    server.run()
    assert server.held() == {"01": (25, "a"), "02": (5, "a")}
    server.has("2025-01-02T18:00", d01=(25, "late"), d02=(12, "b"))
    server.run()  # today comes again, yesterday is closed
    assert server.held() == {"01": (25, "a"), "02": (12, "b")}
    server.has("2025-01-05T09:00", d01=(1, "late"), d02=(31, "c"), d03=(3, "c"), d05=(11, "c"))
    server.run()  # the day that was open comes once more, and those that were missed
    assert server.held() == {"01": (25, "a"), "02": (31, "c"), "03": (3, "c"), "05": (11, "c")}
    lines = {r.day: (r.n, r.status) for r in server.table.manifest().collect()}
    assert lines == {"2025-01-01": (25, "ok"), "2025-01-02": (31, "ok"), "2025-01-03": (3, "ok"), "2025-01-04": (0, "empty"), "2025-01-05": (11, "ok")}


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_batch_that_dies_is_run_again(spark, tmp_path, monkeypatch, when):
    server = Server(spark, tmp_path, open="2")
    server.has("2025-01-02T10:00", d01=(25, "a"), d02=(5, "a"))
    real = SnapshotTable._rename

    def dies(self, old, new):
        if when == "after":
            real(self, old, new)
        raise RuntimeError("killed")

    monkeypatch.setattr(SnapshotTable, "_rename", dies)
    with pytest.raises(Exception, match="killed"):
        server.run()
    monkeypatch.undo()
    assert server.table.table.versions() == ([0] if when == "after" else [])
    server.run()
    first = server.table.table.versions()
    assert server.held() == {"01": (25, "a"), "02": (5, "a")} and first[0] == 0
    server.has("2025-01-03T10:00", d01=(26, "b"), d02=(6, "b"), d03=(1, "b"))
    server.run()  # two days are open at a time
    assert server.held() == {"01": (26, "b"), "02": (6, "b"), "03": (1, "b")}


def test_a_day_that_cannot_be_fetched_fails_the_batch_and_is_not_lost(spark, tmp_path):
    server = Server(spark, tmp_path, identity="")
    server.has("2025-01-03T10:00", d01=(25, "a"), d02=(5, "a"))
    with pytest.raises(Exception, match="more than one page"):
        server.run()
    assert server.table.rows() is None
    server.options["identity"] = "id"
    server.run()
    assert server.held() == {"01": (25, "a"), "02": (5, "a")}
