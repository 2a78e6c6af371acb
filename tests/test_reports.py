from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aeroperf.operators import coverage, nearpairs, reconcile
from aeroperf.plans import flights, taxi
from aeroperf.sources import delimited, rest
from tests import rest_server

T0 = datetime(2026, 1, 1)


def test_examples_and_views(spark):
    rows = [(i, k, T0 + timedelta(minutes=m)) for i, (k, m) in enumerate([("a", 0), ("a", 5), ("b", 0), ("c", 0), ("c", 1)])]
    df = spark.createDataFrame(rows, "i long, k string, s timestamp")
    pairs = spark.createDataFrame([(1, 0), (4, 3)], "row_id long, partner_id long")
    got = nearpairs.examples(df, pairs, ("k",), "i", "s", groups=1).orderBy("i").collect()
    assert [(r.i, r.flagged, r.gap_min) for r in got] == [(0, False, None), (1, True, 5.0)]
    view = nearpairs.before_and_after(df, df.where("i < 1"), F.col("k") == "a", ("i",))
    assert sorted((r.stage, r.i) for r in view.collect()) == [("after", 0), ("before", 0), ("before", 1)]


def test_count_by_and_sides(spark):
    a = spark.createDataFrame([(T0, "x"), (T0, "y")], "t timestamp, c string")
    b = spark.createDataFrame([(T0,)], "t timestamp")
    got = {(r.source, r.year, r.c): r.n for r in coverage.count_by({"a": a, "b": b, "none": spark.range(1)}, "t", ("c",)).collect()}
    assert got == {("a", 2026, "x"): 1, ("a", 2026, "y"): 1, ("b", 2026, None): 1}
    with pytest.raises(ValueError):
        coverage.count_by({"none": spark.range(1)}, "t")
    reads = []
    sides = reconcile.Sides(lambda c: reads.append(c) or a.select(*c), lambda c: b.select("t"))
    sides.get(("t",)), sides.get(("t",)), sides.get(("c",))
    assert reads == [["t"], ["c"]]
    sides.release()


def test_typed_files_and_counts(spark, tmp_path):
    (tmp_path / "g.csv").write_text("DATE,N\n2024-01-01,3\nNA,NA\n")
    got = delimited.read_typed(spark, str(tmp_path / "g.csv"), "DATE string, N long").collect()
    assert [(r.DATE, r.N) for r in got] == [("2024-01-01", 3), (None, None)]
    (tmp_path / "t.json").write_text('[{"d": "2025-01-01"}, {"d": "2025-01-02"}, {"d": "2025-02-01"}]')
    assert rest.count_rows(str(tmp_path), "t", "d", "2025-01-01", "2025-02-01", count=rest_server.folder_count) == 2


def test_profile_and_year_ingest(spark, tmp_path):
    df = spark.createDataFrame([("I|V", "S", "SBGR", "SBSP"), ("V", "G", None, "SBSP")], "li_regravoo string, li_tipovoo string, co_addep string, co_addes string")
    r = flights.traffic_profile(df, ()).first()
    assert (r.n, r.pct_ifr, r.pct_vfr, r.pct_scheduled, r.pct_general, r.pct_no_aerodrome) == (2, 50.0, 50.0, 50.0, 50.0, 50.0)
    row = ["Arr", "", "F1", "X", "SBGR", "", "", "", "", "2024-05-01 10:00:00", "2024-05-01 10:05:00", "B1", "10L", "t"]
    for year in (2023, 2024):
        (tmp_path / f"taxi_{year}.csv").write_text(";".join(taxi.RAW) + "\n" + ";".join(row) + "\n")
    got = taxi.ingest_year(spark, [str(tmp_path / f"taxi_{y}.csv") for y in (2023, 2024)], 2024, str(tmp_path / "out"))
    assert got.count() == 1 and got.first().ICAO == "SBGR"
