import json
import re
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from aeroperf.plans import dashboards, milestones, taxi, terminal
from aeroperf.sinks import files
from aeroperf.sinks.incremental import DailyTable, IncrementalTable, merged_update, prepare_months
from aeroperf.sources import catalog, delimited, json_dir, parquet, rest
from aeroperf.streaming import sessions
from tests import rest_server


def test_ragged_rows_keep_their_extra_field(spark, tmp_path):
    (tmp_path / "a.csv").write_text(";".join(taxi.RAW) + "\nArr" + ";x" * 13 + "\nDep" + ";y" * 13 + ";extra\n")
    df = delimited.read_delimited(spark, str(tmp_path / "a.csv"), taxi.RAW, extra=taxi.EXTRA)
    assert sorted((r.mov, r.V15) for r in df.collect()) == [("Arr", None), ("Dep", "extra")]
    assert delimited.header(spark, str(tmp_path / "a.csv")) == taxi.RAW


def test_separator_by_name_and_zip(spark, tmp_path):
    (tmp_path / "k_2024.csv").write_text("id;c\n1;40\n")
    (tmp_path / "k_jan2025.csv").write_text(",id,c,new\n0,2,100,z\n")
    df = delimited.read_by_separator(spark, [str(tmp_path / n) for n in ("k_2024.csv", "k_jan2025.csv")])
    assert {(r.id, r.c, r.new) for r in df.collect()} == {("1", "40", None), ("2", "100", "z")}
    for n in ("a", "b"):
        with zipfile.ZipFile(tmp_path / f"{n}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.mkdir("sub") if n == "b" else None
            z.writestr("m.csv", f"a;b\n1{n};\n2;x\n")
            z.writestr("sub/o.csv", "a;b\n" + "".join(f"{i};{n}\n" for i in range(60_000)) if n == "b" else "a;b\n")
    got = delimited.read_zipped(spark, f"{tmp_path}/*.zip", ["a", "b"])
    assert got.count() == 60_004 and {tuple(r) for r in got.where("b is null or b = 'x'").collect()} == {("1a", None), ("1b", None), ("2", "x")}


def test_json_directory(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps([{"Callsign": "A", "t": ["a", "b"], "o": {"x": 1}}]))
    (tmp_path / "2.json").write_text("[]")
    (tmp_path / "3.json").write_text(json.dumps([{"Callsign": "A", "t": ["a", "b"], "o": {"x": 1}}, {"Callsign": "B", "EOBT": "t"}]))
    df = json_dir.read_json_dir(spark, str(tmp_path))
    assert df.count() == 3 and {r.t for r in df.collect()} == {"a|b", None}
    got = milestones.ingested(spark, str(tmp_path))
    assert got.count() == 2 and {r.source_file for r in got.collect()} == {"1.json", "3.json"}
    assert milestones.population(got).first()[:] == ("EOBT", 2, 1, 50.0)
    assert "Runway" in milestones.missing_fields(got)


def test_rest_source_pages_every_month(spark, tmp_path):
    rows = [{"id": i, "dt_dia": f"2025-{1 + i % 3:02d}-10", "units": ["a", "b"] if i % 2 else []} for i in range(25)]
    (tmp_path / "flights.json").write_text(json.dumps(rows))
    spark.dataSource.register(rest.RestSource)
    options = {"base": str(tmp_path), "table": "flights", "column": "dt_dia", "start": "2025-01-01", "end": "2025-03-01", "order": "dt_dia,id", "fetch": "tests.rest_server:folder_fetch", "pagerows": "4", "rename": json.dumps({"units": "li_orgaos"})}
    df = spark.read.format("rest").schema("id string, dt_dia string, li_orgaos string").options(**options).load()
    got = df.collect()
    assert sorted(int(r.id) for r in got) == [i for i in range(25) if i % 3 < 2]
    assert {r.li_orgaos for r in got} == {"a|b", None} and df.rdd.getNumPartitions() == 2
    assert rest.total_order("dt", ["pk", "id"], ["id", "dt"]) == "dt,id"
    assert rest.tables({"paths": {"/": 1, "/b": 1, "/a": 1, "/rpc/f": 1}}) == ["a", "b"]


REST = {"table": "f", "column": "dt", "start": "2025-01-01", "end": "2025-02-01", "fetch": "tests.rest_server:folder_fetch"}


def test_filters_sent_along_lose_no_row(spark, tmp_path):
    """What the server is asked for never lacks a row that Spark would keep: quotes, renamed columns, numbers, arrays."""
    rows = [{"dt": "2025-01-10", "id": i, "name": n, "size": s, "units": u, "dh": f"2025-01-10T0{i}:00:00"} for i, (n, s, u) in enumerate([("a,b", 7, ["a", "b"]), ("z", 40, ["a"]), ('say "x"', 5, []), (None, None, None), ("a*", 100, ["z"]), ("", 9, ["a|b"])])]
    (tmp_path / "f.json").write_text(json.dumps(rows))
    spark.dataSource.register(rest.RestSource)
    read = lambda **o: spark.read.format("rest").schema("id string, label string, size string, units string, dh string").options(**REST, base=str(tmp_path), rename=json.dumps({"name": "label"}), **o).load()
    every = spark.createDataFrame(read().collect(), read().schema)
    tests = ["label IN ('a,b', 'z')", "label = 'a,b'", "label = 'say \"x\"' OR size > '5'", "label IN ('say \"x\"', 'q')", "size > '5'", "size = '7'", "units = 'a|b'", "units IS NULL", "label IS NULL", "label LIKE 'a*%'", "label LIKE '%a%'", "label > 'a'", "dh >= '2025-01-10T02:00:00' AND dh < '2025-01-10T05:00:00'", "label = ''", "label <> 'z'"]
    for test in tests:
        want = {r.id for r in every.where(test).collect()}
        assert {r.id for r in read().where(test).collect()} == want == {r.id for r in read(text="name", stamps="dh").where(test).collect()}, test
    reader = rest.RestReader(read().schema, {**REST, "rename": json.dumps({"name": "label"}), "text": "name", "stamps": "dh"})
    list(reader.pushFilters([rest.In(("label",), ("a,b", 'say "x"')), rest.GreaterThan(("size",), "5"), rest.GreaterThanOrEqual(("dh",), "2025"), rest.EqualTo(("units",), "a")]))
    assert reader.where == {"name": 'in.("a,b","say \\"x\\"")', "dh": "gte.2025"}


def test_counts_and_days_of_a_server(spark, tmp_path):
    rows = [{"d": f"2025-01-{day:02d}T10:00:00", "v": i} for day in (1, 3) for i in range(day)]
    (tmp_path / "t.json").write_text(json.dumps(rows))
    assert rest.count_rows(str(tmp_path), "t", "d", "2025-01-01", "2025-01-02", rest_server.folder_count) == 1
    spark.dataSource.register(rest.RestSource)
    df = spark.read.format("rest").schema("d string").options(**REST | {"table": "t", "column": "d"}, base=str(tmp_path), grain="day", tasks="2").load()
    assert df.count() == 4 and df.rdd.getNumPartitions() == 2
    got, days = rest.fetch_days(spark, [date(2025, 1, d) for d in (1, 2, 3)], str(tmp_path), "t", "d", "d string, v string", "tests.rest_server:folder_fetch")
    assert got.count() == 4 and {(r.day, r.n, r.status) for r in days.collect()} == {("2025-01-01", 1, "ok"), ("2025-01-02", 0, "empty"), ("2025-01-03", 3, "ok")}
    got, days = rest.fetch_days(spark, [date(2025, 1, 1)], str(tmp_path / "none"), "t", "d", "d string", "tests.rest_server:folder_fetch", tries=1)
    (day,) = days.collect()
    assert got.count() == 0 and day.status == "failed" and day.n == 0 and "none" in day.error


def test_daily_table_goes_on_where_it_stopped(spark, tmp_path):
    table, asked = DailyTable(spark, str(tmp_path / "d")), []
    (tmp_path / "t.json").write_text(json.dumps([{"d": f"2025-01-0{i}T10", "v": i} for i in (1, 3, 5)]))

    def fetch(wanted):
        asked.append(len(wanted))
        return rest.fetch_days(spark, wanted, str(tmp_path), "t", "d", "v string", "tests.rest_server:folder_fetch")

    got = table.refresh(fetch, date(2025, 1, 1), date(2025, 1, 4), every=3)
    assert asked == [3, 1] and {(r.day, r.status) for r in got.collect()} == {("2025-01-01", "ok"), ("2025-01-02", "empty"), ("2025-01-03", "ok"), ("2025-01-04", "empty")}
    assert sorted((str(r.day), r.v) for r in table.rows().collect()) == [("2025-01-01", "1"), ("2025-01-03", "3")]
    assert table.pending(date(2025, 1, 1), date(2025, 1, 5)) == [date(2025, 1, 4), date(2025, 1, 5)]
    (tmp_path / "t.json").write_text("[]")
    table.refresh(fetch, date(2025, 1, 5), date(2025, 1, 5))
    (tmp_path / "t.json").write_text(json.dumps([{"d": "2025-01-05T10", "v": 9}]))
    table.refresh(fetch, date(2025, 1, 5), date(2025, 1, 6))
    assert ("2025-01-05", "9") in {(str(r.day), r.v) for r in table.rows().collect()}


def test_pages_go_on_below_the_servers_cap():
    rows = list(range(10))
    got = [x for page in rest.pages(lambda b, t, p: rows[int(p["offset"]) : int(p["offset"]) + 3], "", "t", {}, 1000) for x in page]
    assert got == rows


def test_period_filter_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2024, 12, 31, 23, 30),), (datetime(2025, 1, 1),), (datetime(2025, 12, 31, 23, 30),)], "t timestamp")
    df.write.parquet(str(tmp_path / "p"))
    got = parquet.read_period(spark, str(tmp_path / "p"), "t", 2025, columns=["t", "absent"])
    assert got.count() == 2 and "PushedFilters: [IsNotNull(t), GreaterThanOrEqual" in got._jdf.queryExecution().executedPlan().toString()
    paris = parquet.read_period(spark, str(tmp_path / "p"), "t", 2025, stored_zone="Europe/Paris")
    assert {str(r.t) for r in paris.collect()} == {"2025-01-01 00:30:00", "2025-01-01 01:00:00"}


def test_catalog(tmp_path):
    assert catalog.for_years(["x_2023.csv", "x_2024.csv", "y.csv"], {2024}) == ["x_2024.csv", "y.csv"]
    (tmp_path / "a.csv").write_text("")
    assert catalog.resolve("a.csv", ["/nowhere", str(tmp_path)]) == str(tmp_path / "a.csv")
    with pytest.raises(FileNotFoundError):
        catalog.resolve("b.csv", [str(tmp_path)])


def test_incremental_table(spark, tmp_path):
    t = IncrementalTable(spark, str(tmp_path / "t"), "ts", ("pk",), ("seq",))
    data = {(2025, 1): [("a", datetime(2025, 1, d), d) for d in range(1, 32)], (2025, 2): []}
    fetch = lambda y, m: spark.createDataFrame(data.get((y, m), []), "pk string, ts timestamp, seq int")
    assert t.refresh(fetch, date(2025, 1, 1), date(2025, 2, 10)) == [(2025, 1), (2025, 2)]
    assert [(r.pk, r.seq) for r in t.rows().select("pk", "seq").collect()] == [("a", 31)]
    data[(2025, 1)] = [(str(d), datetime(2025, 1, d), d) for d in range(1, 32)]
    assert t.refresh(fetch, date(2025, 1, 1), date(2025, 2, 11)) == [(2025, 1), (2025, 2)]
    assert t.rows().count() == 31 and t.pending(date(2025, 1, 1), date(2025, 2, 12)) == [(2025, 2)]
    t.store(fetch(2025, 2), [(2025, 1)], "2025-02-12")  # a month that has no rows any more
    assert t.rows() is None or t.rows().count() == 0
    with pytest.raises(ValueError):
        t.store(fetch(2025, 1), [(2025, 2)], "2025-02-13")


def test_prepared_months_are_written_once(spark, tmp_path):
    calls = []

    def prepare(year, month):
        calls.append(month)
        return spark.createDataFrame([(month,)] if month != 2 else [], "m int")

    path = str(tmp_path / "p")
    assert prepare_months(spark, path, prepare, (2024, 2026), date(2025, 1, 1), months=(1, 2)) == [(2024, 1), (2026, 1)]
    assert prepare_months(spark, path, prepare, (2025,), date(2025, 4, 2)) == [(2025, 1), (2025, 3)]
    calls.clear()
    assert prepare_months(spark, path, prepare, (2025,), date(2025, 4, 2)) == [] and calls == [2]
    assert prepare_months(spark, path, prepare, (2027,), date(2025, 4, 2)) == []
    assert prepare_months(spark, path, prepare, (2025,), date(2025, 2, 2), force=True) == [(2025, 1)]
    assert spark.read.parquet(path).where("year = 2025").count() == 2


def test_month_in_two_batches_keeps_both(spark, tmp_path):
    """A late row wipes no month, a row that comes again replaces its older self, and null keys stay."""
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    schema = "pk string, ts timestamp, v int"
    for rows in ([("a", datetime(2025, 1, 1), 1), ("b", datetime(2025, 1, 2), 1), (None, datetime(2025, 2, 1), 7)], [("a", datetime(2025, 1, 3), 2), ("c", datetime(2024, 12, 31), 1)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        sessions.refresh_months(spark.readStream.schema(schema).parquet(src), "ts", out, mark).trigger(availableNow=True).start().awaitTermination()
    got = sessions.refreshed(spark.read.parquet(out), ("pk",), ("ts",))
    assert {(r.pk, r.v) for r in got.collect()} == {("a", 2), ("b", 1), ("c", 1), (None, 7)}


def test_origin_orders_the_rows_of_a_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n\n" + "".join(f"{i:08d}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = delimited.read_delimited(spark, str(tmp_path / "a.csv"), ["n"], with_origin=True)
        assert df.rdd.getNumPartitions() > 3
        assert [r.n for r in df.orderBy("_file", "_block", "_seq").collect()] == [f"{i:08d}" for i in range(20_000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_names_and_newest_file(spark, tmp_path):
    import os

    name = catalog.analytic_name("P", "BRA", "txxt-analytic", 2024, 2024, "v.1")
    assert name == "P-BRA-txxt-analytic-2024-ref2024-v.1.csv" and re.match(catalog.analytic_pattern("P", "BRA", "txxt-analytic", 2024, "v.1"), name)
    assert not re.match(catalog.analytic_pattern("P", "BRA", "txxt-analytic", 2024, "v.1"), name.replace("v.1", "vx1")) and catalog.analytic_name("P", "BRA", "cov", (2024, 2026)) == "P-BRA-cov-2024-2026.csv"
    for i, n in enumerate(("b_1.csv", "a_1.csv", "c.txt")):
        (tmp_path / n).write_text("x")
        os.utime(tmp_path / n, (1000 + i, 1000 + i))
    assert catalog.newest(spark, str(tmp_path), r"_1\.csv$").endswith("a_1.csv")
    with pytest.raises(FileNotFoundError):
        catalog.newest(spark, str(tmp_path), "nothing")


def test_names_captured_headers_lowered_and_inventory(spark, tmp_path):
    spark.createDataFrame([("x", datetime(2025, 1, 2))], "ID string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = catalog.from_file_name(df, r"^(part)-(\d+)", ("kind", "number")).first()
    assert (got.kind, got.number) == ("part", "00000")
    assert delimited.lower_cased(df, ["id", "absent"]).columns == ["id"] and delimited.lower_cased(df).columns == ["id", "ts"]
    (line,) = [r for r in catalog.inventory(spark, df, str(tmp_path / "t"), "ts").collect() if r.rows]
    assert line.rows == 1 and str(line.first) == "2025-01-02 00:00:00" and line.size > 0

def test_merged_update_keeps_last(spark):
    schema = "pk string, ts timestamp, v int"
    old = spark.createDataFrame([("a", datetime(2025, 1, 1), 1), ("b", datetime(2025, 2, 1), 1), (None, datetime(2025, 2, 1), 7)], schema)
    new = spark.createDataFrame([("a", datetime(2025, 1, 2), 2), (None, datetime(2025, 1, 2), 8)], schema)
    got = merged_update(old, new, spark.createDataFrame([(2025, 1)], "year int, month int"), "ts", ("pk",), ("v",))
    assert {(r.pk, r.v) for r in got.collect()} == {("a", 2), ("b", 1), (None, 7), (None, 8)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2024, "a", None), (2025, "b", "x")], "YEAR int, a string, b string")
    files.write_delimited(df, str(tmp_path / "c"), one_file=True)
    body = next((tmp_path / "c").glob("part-*")).read_text()
    assert body.splitlines()[0] == '"YEAR";"a";"b"' and '"2025";"b";"x"' in body
    files.write_by_year(df, str(tmp_path / "y"), "YEAR")
    files.write_by_year(df.where("YEAR = 2025").withColumn("a", F.lit("new")), str(tmp_path / "y"), "YEAR")
    assert {(r.YEAR, r.a) for r in spark.read.parquet(str(tmp_path / "y")).collect()} == {(2024, "a"), (2025, "new")}
    with pytest.raises(ValueError):
        files.guard_raw("/x/data-raw/a.csv")


def test_taxi_plan(spark):
    head = ["mov", "dh_bimtra", "dh_vra", "box", "pista", "adpartida", "addestino"]
    rows = [["Arr", "2024-05-01 10:00:00", f"2024-05-01 10:{m:02d}:00", "B1", "10L", "X", "SBGR"] for m in (5, 6, 7, 8, 9, 10)]
    rows += [["Arr", "2024-05-01 23:50:00", "2024-05-02 00:05:00", "B1", "10L", "X", "SBGR"], ["Dep", "2024-05-01 10:00:00", "", "B1", "10L", "SBGR", "Y"], ["XXX", "2024-05-01 10:00:00", "", "", "", "SBGR", "Y"], ["Arr", "2024-05-01 10:00:00", "2024-05-01 09:00:00", "\tB1 ", "10L", "X", "SBGR"]]
    df = taxi.harmonised(spark.createDataFrame(rows, ", ".join(f"{h} string" for h in head)), ("SBGR",))
    assert df.count() == 9
    got = {(r.PHASE, str(r.DATE)): r for r in taxi.daily(df).collect()}
    assert (got["ARR", "2024-05-01"].MVTS_VALID, got["ARR", "2024-05-01"].MVTS_NA) == (6, 1) and got["ARR", "2024-05-02"].TOT_TXXT == 15.0
    assert (got["DEP", "2024-05-01"].MVTS_VALID, got["DEP", "2024-05-01"].MVTS_NA, got["DEP", "2024-05-01"].TOT_TXXT) == (0, 1, 0.0)
    total = taxi.coverage(taxi.daily(df)).agg(F.sum("MVTS_TOTAL")).first()[0]
    assert total == 9 and set(taxi.reference_windows(df)) == {"none", "date", "movement", "block"}
    payload = dashboards.taxi_payload(taxi.daily(df).withColumn("REGION", F.lit("BRA")))
    assert json.loads(payload["airports"].first()[0])["BRA"]["SBGR"]["ARR"]["2024"]["mvts"] == 8


def test_terminal_plan(spark):
    head = ["id", "ades", "CLASS", "drwy_validado", "drwy", "aldt", "c", "c_time", "setor", "transito", "desimp", "kpi08"]
    base = ["SBGR", "M", "", "10L", "2024-03-01 10:00:00"]
    rows = [[str(i), *base, "40", f"2024-03-01 09:4{i}:00", "60", "", "0:10:00", "0:01:00"] for i in range(6)]
    rows += [["0", *base, "40", "2024-03-01 09:00:00", "60", "", "", ""], ["7", *base, "100", "", "360", "0:13:48", "", ""], ["8", *base, "", "", "", "", "", ""]]
    df = terminal.harmonised(spark.createDataFrame(rows, ", ".join(f"{h} string" for h in head)))
    assert df.count() == 8  # the ring without a number is gone
    once = terminal.once_per_ring(df, ("CROSS_TIME",))
    assert once.count() == 7
    got = {r.RANGE: r for r in terminal.daily(df).collect()}
    assert got["C40"].MVTS_VALID == 7 and got["C100"].MVTS_NA == 1 and got["C40"].TOT_SUPPLIED_ADD == 6.0
    wide = terminal.wide(once)
    assert wide.count() == 7 and terminal.long(wide).count() == 7 and "C40_TRANSIT" in wide.columns
    audit = terminal.null_audit(df).first()
    assert (audit.N_TOTAL, audit.N_MISSING_CLASS, audit.N_VALID) == (8, 0, 8)
    assert {(r.RANGE, r.N_REFERENCE_GROUPS, r.N_VALID_REFERENCE_GROUPS) for r in terminal.reference_coverage(df).collect()} == {("C40", 1, 1), ("C100", 1, 0)}


def test_sources_below_a_folder(tmp_path, monkeypatch):
    for n in ("a.parquet", "2024.csv", "2024-01.csv", "sub/b.parquet", "sub/2025-12.csv", "note.txt"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_text("")
    got = catalog.find_sources(str(tmp_path))
    names = lambda paths: [p.removeprefix(f"{tmp_path}/") for p in paths]
    assert names(got.parquet) == ["a.parquet", "sub/b.parquet"] and names(got.csv) == ["2024.csv"] and got.parts == []
    assert names(catalog.find_sources("/nowhere", include_parts=True, env="ARCHIVE").parts) == []
    monkeypatch.setenv("ARCHIVE", str(tmp_path))
    assert names(catalog.find_sources("/nowhere", include_parts=True, env="ARCHIVE").parts) == ["2024-01.csv", "sub/2025-12.csv"]


def test_types_and_zones_that_a_file_states(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    stamps = pa.array([datetime(2025, 1, 1)], pa.timestamp("us"))
    pq.write_table(pa.table({"dh_a": stamps.cast(pa.timestamp("us", "America/Sao_Paulo")), "dh_b": stamps, "dt_c": ["2025-01-01"], "name": ["x"]}), tmp_path / "z.parquet")
    assert parquet.stored_zones(str(tmp_path / "z.parquet")) == {"dh_a": "America/Sao_Paulo", "dh_b": None}
    assert parquet.schema_info(spark.read.parquet(str(tmp_path / "z.parquet"))) == [("dh_a", "timestamp", False), ("dh_b", "timestamp_ntz", False), ("dt_c", "string", True), ("name", "string", False)]
    assert parquet.read_available(spark, str(tmp_path / "z.parquet"), ["name", "absent"], ["absent"]) is None


def test_columns_that_may_hold_dates():
    assert rest.date_columns(["dt_dia", "dh_fim", "name", "update_time", "startdate", "width", "Timestamp", "adh"]) == ["dt_dia", "dh_fim", "update_time", "startdate", "Timestamp"]


def test_a_payload_goes_to_any_store(spark, tmp_path):
    one = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")
    path = f"file://{tmp_path}/sub/p.js"
    files.write_payload({"x": files.payload_json(one, ("k",), F.struct("n"))}, path, "SET")
    assert (tmp_path / "sub" / "p.js").read_text() == 'window.SET = {"x":{"a":{"n":1},"b":{"n":null}}};\n'
    with pytest.raises(ValueError):
        files.write_payload({}, "/x/data-raw/p.js")
