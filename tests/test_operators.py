"""Islands, matching, components and merges against brute force and worked cases."""

import random
from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aeroperf.config import KpiSpec, MatchSpec, MergeSpec
from aeroperf.operators import coverage, dedup, islands, kpi, nearest, nearpairs, reconcile, reshape
from aeroperf.operators.components import connected_components
from aeroperf.plans import flights
from aeroperf.streaming import sessions

T0 = datetime(2026, 1, 1)
SPEC = MergeSpec(("k",), "s", "e", order=("i",), gap_min=60.0, union_cols=("u",), filled_cols=("v",), identity="i", prefer_filled="v")
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_islands(rows, gap):
    out, by = {}, {}
    for k, s, e, i in sorted(rows, key=lambda r: (str(r[0]), r[1], r[3])):
        e = max(s, e if e is not None else s)
        end, n = by.get(k, (None, 0))
        if end is None or (s - end) > timedelta(minutes=gap):
            n += 1
            end = e
        by[k] = (max(end, e), n)
        out[i] = n
    return out


@SLOW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 600), st.one_of(st.none(), st.integers(-30, 200))), min_size=1, max_size=40))
def test_islands_equal_brute_force(spark, rows):
    data = [(k, T0 + timedelta(minutes=s), None if d is None else T0 + timedelta(minutes=s + d), i) for i, (k, s, d) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, s timestamp, e timestamp, i long")
    want = brute_islands([(k, s, e, i) for k, s, e, i in data], 60)
    for spec in (SPEC, replace(SPEC, split_by="hour")):
        assert {r.i: r.island for r in islands.chain(df, spec).collect()} == want


def test_exact_gap_joins_and_a_microsecond_more_splits(spark):
    def n(extra):
        rows = [("a", T0, T0, 1, "x", "u"), ("a", T0 + timedelta(minutes=60, microseconds=extra), None, 2, "", "u")]
        return islands.merged(spark.createDataFrame(rows, "k string, s timestamp, e timestamp, i long, v string, u string"), SPEC).count()

    assert (n(0), n(1)) == (1, 2)


def test_null_keys_and_starts_stay_alone(spark):
    rows = [(None, T0, T0, 1, None, "b"), (None, T0, T0, 2, None, "a"), ("a", None, T0, 3, "x", None)]
    got = islands.merged(spark.createDataFrame(rows, "k string, s timestamp, e timestamp, i long, v string, u string"), SPEC).collect()
    assert sorted(r.N_MERGED for r in got) == [1, 1, 1] and all(r.ZERO_SPAN_ONLY is None for r in got)
    assert islands.merged(spark.createDataFrame([], "k string, s timestamp, e timestamp, i long, v string, u string"), SPEC).count() == 0


def test_worked_flight(spark):
    rows = [
        ("1", "CMP486", "MPTO", "SBGL", "HP9926", "2026-01-01 02:15:00", "2026-01-01 04:03:02", "ACCAZ"),
        ("2", "CMP486", "MPTO", "SBGL", "HP9928", "2026-01-01 04:58:00", "2026-01-01 06:32:00", "ACCCW|ACCBS"),
        ("3", "CMP486", "MPTO", "SBGL", None, "2026-01-01 07:01:33", "2026-01-01 07:01:33", "APPRJ"),
        ("4", "CMP486", "MPTO", "SBGL", "HP9922", "2026-01-02 01:49:00", "2026-01-02 06:35:00", "ACCBS|APPRJ|ACCCW|ACCAZ"),
    ]
    df = spark.createDataFrame(rows, "pk string, co_indicativo string, co_addep string, co_addes string, co_matricula string, dh_inicio string, dh_fim string, li_orgaos string")
    a, b = flights.prepared(df).orderBy("dh_inicio").collect()
    assert (a.N_MERGED, round(a.SPAN_MIN, 1), a.li_orgaos, a.co_matricula, a.ZERO_SPAN_ONLY, a.MERGED_IDS) == (3, 286.6, "ACCAZ|ACCBS|ACCCW|APPRJ", "HP9926", False, "1|2|3")
    assert (b.N_MERGED, b.SPAN_MIN) == (1, 286.0)
    assert flights.prepared(df, 45).count() == 3
    counted = flights.prepared_with_steps(df)
    assert counted.frame.count() == 2 and counted.steps == {"read": 4, "collapsed": 0, "kept": 4, "merged": 2, "out": 2}
    whole = flights.prepared(df)
    again = flights.joined_months([flights.prepared(df.where("pk < '3'")), flights.prepared(df.where("pk >= '3'"))])
    assert {(str(r.dh_inicio), str(r.dh_fim), r.N_MERGED, r.li_orgaos) for r in again.collect()} == {(str(r.dh_inicio), str(r.dh_fim), r.N_MERGED, r.li_orgaos) for r in whole.collect()}


def test_merging_again_changes_nothing(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), T0 + timedelta(minutes=rng.randrange(900)), None, i, rng.choice(["", "x"]), rng.choice("pq")) for i in range(40)]
    once = islands.merged(spark.createDataFrame(rows, "k string, s timestamp, e timestamp, i long, v string, u string"), SPEC)
    once = once.withColumn("i", F.substring_index("MERGED_IDS", "|", 1).cast("long"))
    twice = islands.merged(once, SPEC)
    assert sum(r.N_MERGED for r in once.collect()) == 40
    key = lambda df: sorted((r.k, r.s, r.e, r.N_MERGED, r.MERGED_IDS, r.ZERO_SPAN_ONLY) for r in df.collect())
    assert [x[:5] for x in key(once)] == [x[:5] for x in key(twice)]


@pytest.mark.parametrize("split", [None, "hour"])
def test_parts_merge_to_the_whole(spark, split):
    """A filled value without a span before a bound, spans of blank rows beside it, zero spans on both sides."""
    at = lambda m: T0 + timedelta(minutes=m)
    rows = [("a", at(0), at(0), 1, "first", "p"), ("a", at(5), at(20), 2, None, "q"), ("a", at(40), at(50), 3, "spans", "r"), ("b", at(0), None, 4, "x", "p"), ("b", at(10), None, 5, "y", "p"), ("b", at(40), None, 6, " ", "q"), ("c", None, None, 7, "z", "p")]
    rng = random.Random(5)
    rows += [(rng.choice("def"), at(m := rng.randrange(900)), rng.choice([None, at(m), at(m + 30)]), 10 + i, rng.choice([None, " ", "x", "y", "z"]), rng.choice("pq")) for i in range(90)]
    df = spark.createDataFrame(rows, "k string, s timestamp, e timestamp, i long, v string, u string")
    kind = replace(SPEC, filled_cols=("v",), prefer_filled="v", split_by=split)
    bounds = (F.col("s").isNull() | (F.col("s") < at(30)), (F.col("s") >= at(30)) & (F.col("s") < at(400)), F.col("s") >= at(400))
    parts = [islands.merged(df.where(b), kind, places=True).withColumn("i", F.substring_index("MERGED_IDS", "|", 1).cast("long")) for b in bounds]
    whole = islands.merged(df, kind)
    plain = lambda x: sorted(map(repr, x.select(*whole.columns).collect()))
    assert plain(islands.merge_parts(parts, kind)) == plain(whole)


def test_same_key_collapse(spark):
    from aeroperf.operators.collapse import collapse_same_key

    rows = [("K1", "APPAN", None, 1), ("k1", "APPAN,APPAN", "2023-03-02", 2), (None, "A", None, 3), (" ", "B", None, 4)]
    got = {r.pk: r for r in collapse_same_key(spark.createDataFrame(rows, "pk string, li string, eet string, o int"), "pk", ("o",), ("li",)).collect()}
    assert len(got) == 3 and (got["K1"].li, got["K1"].eet, got["K1"].N_KEY_MERGED) == ("APPAN", "2023-03-02", 2)


@SLOW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 50)), max_size=25), st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 50)), max_size=25))
def test_nearest_equals_brute_force(spark, left, right):
    l = [(k, T0 + timedelta(minutes=m), i) for i, (k, m) in enumerate(left)]
    r = [(k, T0 + timedelta(minutes=m), 100 + i) for i, (k, m) in enumerate(right)]
    schema = "k string, t timestamp, i long"
    spec = MatchSpec(("k",), "i", "i", "t", "t", 10.0)
    sides = spark.createDataFrame(l, schema), spark.createDataFrame(r, schema)
    got = {x.left_id: x.right_id for x in nearest.nearest(*sides, spec).collect()}
    assert got == {x.left_id: x.right_id for x in nearest.nearest(*sides, replace(spec, split_by="minute")).collect()}
    want = {}
    for k, t, i in l:
        near = sorted((abs(t - u), u, j) for kk, u, j in r if kk == k)
        if near and near[0][0] <= timedelta(minutes=10):
            want[i] = near[0][2]
    assert got == want


def test_one_to_one_is_one_to_one(spark):
    rows = [(1, 9, 5.0), (2, 9, 5.0), (3, 9, 1.0), (3, 8, -1.0)]
    got = nearest.one_to_one(spark.createDataFrame(rows, "left_id long, right_id long, diff_min double")).collect()
    assert {(r.left_id, r.right_id) for r in got} == {(3, 8)} | {(1, 9)}


def test_cross_source_example(spark):
    at = lambda m: T0 + timedelta(minutes=m)
    a = spark.createDataFrame([("k", at(100), 1), ("k", at(200), 2), ("k", at(400), 3)], "k string, t timestamp, i long")
    b = spark.createDataFrame([("k", at(90), 11), ("k", at(195), 12), ("k", at(205), 13)], "k string, t timestamp, i long")
    spec = MatchSpec(("k",), "i", "i", "t", "t", 120.0, shift_min=-10.0)
    pairs = nearest.match(a, b, spec)
    assert {(r.left_id, r.right_id, r.diff_min) for r in pairs.collect()} == {(1, 11, 0.0), (2, 12, 5.0)}
    assert nearest.match_summary(a, b, pairs).first()[:] == (2, 1, 1)


def test_near_pairs_rules(spark):
    at = lambda m: T0 + timedelta(minutes=m)
    rows = [(1, "k", at(0), at(0), "A"), (2, "k", at(13.6), at(50), "A"), (3, "k", at(23.6), at(60), "B"), (4, "k", at(33.6), at(70), None)]
    got = nearpairs.near_pairs(spark.createDataFrame(rows, "i long, k string, s timestamp, e timestamp, r string"), ("k",), "i", "s", "e", "r").collect()
    assert {(r.row_id, r.partner_id, r.kind) for r in got} == {(1, 2, "plan + movement"), (4, 3, "repeated movement")}


@SLOW
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components_equal_union_find(spark, pairs):
    parent = {x: x for p in pairs if p[0] != p[1] for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = connected_components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {x: root(x) for x in parent}


def test_reference_needs_five_and_uses_a_closed_window(spark):
    x = [3.2, 7.7, 9.1, 1.05, 22.3, 5.5, 8.8]
    stamp = datetime(2024, 6, 1)
    rows = [("a", v, stamp) for v in x] + [("a", 0.0, stamp), ("a", 120.01, stamp), ("b", 5.0, stamp)] + [(None, 1.0, stamp)] * 9 + [("c", 2.0, datetime(2024, 12, 31, 23, 59, 59))] * 5 + [("c", 1.0, datetime(2024, 12, 31, 23, 59, 59, 500000))] * 5
    spec = KpiSpec(("k",), "d", "day", 120.0, window_col="t", window=("2024-01-01 00:00:00", "2024-12-31 23:59:59"))
    got = {r.k: (r.n, round(r.reference, 6)) for r in kpi.reference(spark.createDataFrame(rows, "k string, d double, t timestamp"), spec).collect()}
    assert got == {"a": (7, 3.66), "c": (5, 2.0)}


def test_additional_time_is_total_minus_reference(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice([None, "s"]), rng.uniform(-5, 140), T0) for _ in range(300)]
    spec = KpiSpec(("k", "s"), "d", "day", 120.0)
    df = spark.createDataFrame(rows, "k string, s string, d double, day timestamp")
    for r in kpi.percentile_kpi(df, spec, ("k", "s")).collect():
        assert abs(r.TOT_ADD - (r.TOT - r.TOT_REF)) < 1e-6
        assert r.s is not None or r.MVTS_VALID == 0
    assert sum(r.MVTS_VALID + r.MVTS_NA for r in kpi.percentile_kpi(df, spec, ("k",)).collect()) == 300


def test_keep_one_exempts_null_keys(spark):
    df = spark.createDataFrame([(1, None, 1), (2, None, 2), (3, "a", 1), (4, "a", 2)], "i int, k string, o int")
    assert {r.i for r in dedup.keep_one(df, ("k",), ("o",), last=True, null_key="keep").collect()} == {1, 2, 4}
    assert {r.i for r in dedup.keep_one(df, ("k",), ("o",)).collect()} == {1, 3}


def test_widen_and_back(spark):
    df = spark.createDataFrame([(1, None, "A", 5), (1, None, "B", 6), (2, "x", "A", 7)], "i int, n string, r string, v int")
    wide = reshape.widened(df, ("i", "n"), "r", ("A", "B"), ("v",))
    assert {tuple(r) for r in wide.collect()} == {(1, None, 5, 6), (2, "x", 7, None)}
    assert {tuple(r) for r in reshape.lengthened(wide, ("i", "n"), "r", ("A", "B"), ("v",)).collect()} == {tuple(r) for r in df.collect()}


def test_null_safe_diff(spark):
    a, b = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "i int, k string"), spark.createDataFrame([(1, None), (3, "y")], "i int, k string")
    assert reconcile.keyed_diff(a, b, ("i", "k")).first()[:] == (2, 2, 1, 1, 1)
    assert reconcile.only_left(a, b, ("i", "k")).count() == 2


def test_verdicts(spark):
    g = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "k string, v double")
    assert reconcile.validate(g, g, ("k",), ("v",)).first().verdict == "PASS"
    assert reconcile.validate(g, g.withColumn("v", F.col("v") + 1), ("k",), ("v",)).first().verdict == "FAIL"


def test_missing_days_and_open_year(spark):
    df = spark.createDataFrame([(datetime(2025, 1, d),) for d in (1, 3)] + [(None,)], "t timestamp")
    assert [str(r.day) for r in coverage.missing_days(df, "t", "2025-01-01", "2025-01-04").orderBy("day").collect()] == ["2025-01-02", "2025-01-04"]
    got = {r.year: (r.days, r.possible, r.complete) for r in coverage.year_coverage(df, "t", (2024, 2025, 2026), "2025-01-03").collect()}
    assert got == {2024: (0, 366, False), 2025: (2, 3, True), 2026: (0, 0, False)}


@pytest.mark.parametrize("minutes,n", [(59, 1), (60, 1), (61, 2)])
def test_session_bounds(spark, minutes, n):
    df = spark.createDataFrame([("a", T0, T0), ("a", T0 + timedelta(minutes=minutes), None)], "k string, s timestamp, e timestamp")
    assert sessions.island_sessions(df, ("k",), "s", "e", 60.0, "1 day").count() == n


def test_streamed_islands_equal_batch(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), T0 + timedelta(minutes=rng.randrange(3000)), i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, s timestamp, i long")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")).withColumn("e", F.col("s"))
    q = sessions.island_sessions(stream, ("k",), "s", "e", 60.0, "0 seconds").writeStream.format("memory").queryName("islands").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.k, r.start, r.end, r.n) for r in spark.table("islands").collect()}
    want = {(r.k, r.start, r.end, r.n) for r in sessions.island_sessions(df.withColumn("e", F.col("s")), ("k",), "s", "e", 60.0, "0 seconds").collect()}
    assert got and got <= want and len(want) - len(got) <= 2  # the last islands are still open


def test_stream_keeps_first_of_each(spark, tmp_path):
    df = spark.createDataFrame([("a", T0), ("a", T0), ("b", T0)], "k string, t timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = sessions.first_of_each(stream, ("k",), "t", "1 hour").writeStream.format("memory").queryName("firsts").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r.k for r in spark.table("firsts").collect()) == ["a", "b"]


def test_percentiles_of_any_size_equal_numpy(spark):
    """Repeated values, nulls, one value alone, a null group and a group of no value, over many partitions."""
    rng = np.random.default_rng(0)
    groups = {"a": rng.integers(0, 20, 500).astype(float), "b": rng.standard_normal(2001), "c": np.array([3.5]), None: np.array([1.0, 2.0])}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("a", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    ps = (0.0, 0.2, 0.5, 0.99, 1.0)
    got = {r.g: [r[f"p{round(100 * p):02d}"] for p in ps] for r in kpi.percentiles(df, ("g",), "x", ps).collect()}
    assert set(got) == set(groups) and all(np.allclose(got[g], np.quantile(xs, ps)) for g, xs in groups.items())
    (whole,) = kpi.percentiles(df, (), "x", (0.5,)).collect()
    assert np.isclose(whole.p50, np.median(np.concatenate(list(groups.values()))))
    assert kpi.percentiles(df.limit(0), ("g",), "x", (0.5,)).count() == 0
