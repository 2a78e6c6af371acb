"""More bound queries: reports on two sources, and what sources and sinks write and read back."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroperf.bindings.driver import COLLAPSED_SQL, EDGES_SQL, LEG_KEY, LEG_SPEC, MATCH, MERGED_SQL, NEAR_SQL, PAIRS_SQL, VERSIONS_SQL, VISIT, VISITS_SQL, Reader, bind, clicks, collapsed, legs, purchases, record_pairs, records, rounded, spelled, stamp, versions, visits
from aeroperf.config import MatchSpec
from aeroperf.functions import time
from aeroperf.operators import compare, coverage, dedup, islands, nearest, nearpairs, reconcile, refstate, sides
from aeroperf.plans import flights, taxi, terminal
from aeroperf.sinks import files, incremental
from aeroperf.sources import catalog, delimited, parquet
from aeroperf.streaming import sessions, stateful

# --- two sources --------------------------------------------------------------------------------------------------

ONLY_SQL = f"""{VERSIONS_SQL},
ol AS (SELECT 'left' AS side, o_orderkey, o_custkey, o_orderstatus FROM lv WHERE NOT EXISTS (SELECT 1 FROM rv WHERE rv.k IS NOT DISTINCT FROM lv.k AND rv.priority IS NOT DISTINCT FROM lv.priority)),
orr AS (SELECT 'right' AS side, o_orderkey, o_custkey, o_orderstatus FROM rv WHERE NOT EXISTS (SELECT 1 FROM lv WHERE lv.k IS NOT DISTINCT FROM rv.k AND lv.priority IS NOT DISTINCT FROM rv.priority))"""
ONLY = ("side", "o_orderkey", "o_custkey")
K = ("k", "priority")


@bind("unmatched_rows", f"WITH {ONLY_SQL} SELECT side, o_orderkey, o_custkey FROM ol UNION ALL SELECT side, o_orderkey, o_custkey FROM orr")
def _(t):
    return compare.unmatched(*versions(t), K).select(*ONLY)


@bind("source_examples", f"WITH {ONLY_SQL} (SELECT side, o_orderkey, o_custkey FROM ol ORDER BY o_orderkey LIMIT 10) UNION ALL (SELECT side, o_orderkey, o_custkey FROM orr ORDER BY o_orderkey LIMIT 10)")
def _(t):
    return compare.both_examples(*versions(t), K, ("o_orderkey",), 10).select(*ONLY)


@bind("shared_examples", f"WITH {VERSIONS_SQL}, s AS (SELECT DISTINCT o_orderkey FROM lv JOIN rv USING (o_orderkey) ORDER BY o_orderkey LIMIT 20) SELECT 'left' AS side, o_orderkey, o_custkey FROM lv JOIN s USING (o_orderkey) UNION ALL SELECT 'right', o_orderkey, o_custkey FROM rv JOIN s USING (o_orderkey)")
def _(t):
    return compare.side_examples(*versions(t), ("o_orderkey",), "both", ("o_orderkey",)).select(*ONLY)


@bind("identifier_shape", """WITH b AS (SELECT 'left' AS side, p_brand AS v FROM part UNION ALL SELECT 'right', p_type FROM part)
SELECT side, count(*) AS n, min(length(v)) AS min_length, max(length(v)) AS max_length, bool_and(regexp_matches(v, '^Brand#[0-9]+$')) AS all_match, min(v) AS example FROM b WHERE coalesce(v, '') <> '' GROUP BY side""")
def _(t):
    return compare.identifier_shape(t("part").select(F.col("p_brand").alias("v")), t("part").select(F.col("p_type").alias("v")), "v", "^Brand#[0-9]+$")


@bind("identifier_examples", f"WITH {VERSIONS_SQL} SELECT o_orderkey, l.o_custkey AS o_custkey_l, l.priority AS priority_l, r.o_custkey AS o_custkey_r, r.priority AS priority_r FROM lv l JOIN rv r USING (o_orderkey) ORDER BY o_orderkey LIMIT 10")
def _(t):
    return compare.identifier_examples(*versions(t), ("o_orderkey",), ("o_custkey", "priority"), ("o_custkey",))


PIECES = {"customer": ("o_custkey",), "status": ("o_orderstatus",), "customer and status": ("o_custkey", "o_orderstatus"), "key": ("k",)}


@bind("piece_overlap", f"WITH {VERSIONS_SQL}, p AS (" + " UNION ALL ".join(f"SELECT '{name}' AS piece, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(c)} FROM lv)) AS n_left, (SELECT count(*) FROM (SELECT {', '.join(c)} FROM lv INTERSECT SELECT {', '.join(c)} FROM rv)) AS shared" for name, c in PIECES.items()) + ") SELECT piece, n_left, shared, round(100.0 * shared / n_left, 1) AS pct_shared FROM p")
def _(t):
    return compare.piece_overlap(*versions(t), PIECES)


@bind("clock_offsets", f"WITH {NEAR_SQL}, h AS (SELECT CAST(round(-d) AS BIGINT) AS o, count(*) AS n FROM n WHERE k = 1 GROUP BY ALL) SELECT 'ts' AS time, o AS \"offset\", n, round(100.0 * n / sum(n) OVER (), 1) AS pct FROM h")
def _(t):
    out = compare.clock_offsets(clicks(t), purchases(t), ("user_id",), "event_id", ("ts",))
    return out.select("time", F.col("offset").cast("long").alias("offset"), "n", "pct")


LEFT_OVER_SQL = f"""{PAIRS_SQL},
a AS (SELECT event_id, user_id, user_id % 20 AS g, s FROM f JOIN (SELECT event_id, event_type FROM events) USING (event_id) WHERE event_type = 'purchase' AND NOT plan), b AS (SELECT event_id, user_id, user_id % 20 AS g, s FROM f JOIN (SELECT event_id, event_type FROM events) USING (event_id) WHERE event_type = 'click' AND NOT plan),
n1 AS (SELECT a.event_id AS l, b.event_id AS r, (epoch_us(b.s) - epoch_us(a.s)) / 60e6 AS d, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(epoch_us(b.s) - epoch_us(a.s)), b.s, b.event_id) AS k FROM a JOIN b ON a.user_id = b.user_id),
m1 AS (SELECT l, r FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY abs(d), l) AS j FROM n1 WHERE k = 1 AND abs(d) <= 120) WHERE j = 1),
a2 AS (SELECT * FROM a WHERE event_id NOT IN (SELECT l FROM m1)), b2 AS (SELECT * FROM b WHERE event_id NOT IN (SELECT r FROM m1)),
n2 AS (SELECT a2.event_id AS l, b2.event_id AS r, (epoch_us(b2.s) - epoch_us(a2.s)) / 60e6 AS d, row_number() OVER (PARTITION BY a2.event_id ORDER BY abs(epoch_us(b2.s) - epoch_us(a2.s)), b2.s, b2.event_id) AS k FROM a2 JOIN b2 ON a2.g = b2.g),
m2 AS (SELECT l, r FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY abs(d), l) AS j FROM n2 WHERE k = 1 AND abs(d) <= 60) WHERE j = 1)"""
TIMED = MatchSpec(("user_id",), "event_id", "event_id", "s", "s", 120.0)
PASSES = [("user", ("user_id",), 120.0), ("group", ("g",), 60.0)]


def two_kinds(t: Reader) -> tuple[DataFrame, DataFrame]:
    r = records(t).withColumn("g", F.col("user_id") % 20)
    return r.where("types = 'purchase'"), r.where("types = 'click'")


@bind("nearest_leftovers", f"WITH {LEFT_OVER_SQL} SELECT 'left' AS side, event_id FROM a2 UNION ALL SELECT 'right', event_id FROM b2")
def _(t):
    return compare.nearest_leftovers(*two_kinds(t), TIMED, end="e")[0].select("side", "event_id")


@bind("leftovers_explained", f"""WITH {LEFT_OVER_SQL} SELECT 'user' AS pass, (SELECT count(*) FROM m1) AS n_paired, (SELECT count(*) FROM a2) AS left_over, (SELECT count(*) FROM b2) AS right_over
UNION ALL SELECT 'group', (SELECT count(*) FROM m2), (SELECT count(*) FROM a2) - (SELECT count(*) FROM m2), (SELECT count(*) FROM b2) - (SELECT count(*) FROM m2)""")
def _(t):
    return compare.explained(*two_kinds(t), TIMED, PASSES, end="e")[0]


@bind("leftovers_by_month", f"""WITH {LEFT_OVER_SQL}, res AS (SELECT 'left' AS side, s FROM a2 WHERE event_id NOT IN (SELECT l FROM m2) UNION ALL SELECT 'right', s FROM b2 WHERE event_id NOT IN (SELECT r FROM m2))
SELECT side, strftime(s, '%Y-%m') AS month, count(*) AS n_rows FROM res GROUP BY ALL""")
def _(t):
    return compare.by_month(compare.explained(*two_kinds(t), TIMED, PASSES, end="e")[1], ("side",), "s")


@bind("plans_left_out", f"WITH {PAIRS_SQL} SELECT count(*) FILTER (WHERE plan) AS n_plans FROM f")
def _(t):
    return nearpairs.without_plans(records(t), "s", "e")[1]


@bind("untestable_rows", """WITH o AS (SELECT o_orderstatus, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS t, CASE WHEN o_custkey % 5 = 0 THEN ' ' ELSE o_orderpriority END AS c FROM orders)
SELECT o_orderstatus, count(*) AS residual, count(*) - count(t) AS no_time, count(*) FILTER (WHERE trim(c) = '') AS no_callsign, round(100.0 * count(*) FILTER (WHERE t IS NULL OR trim(c) = '') / count(*), 1) AS pct_untestable FROM o GROUP BY ALL""")
def _(t):
    o = t("orders").withColumns({"t": F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")), "c": F.when(F.col("o_custkey") % 5 == 0, " ").otherwise(F.col("o_orderpriority"))})
    return compare.untestable(o, ("o_orderstatus",), "t", "c")


@bind("traffic_classes", """WITH p AS (SELECT p_type, CASE p_size % 4 WHEN 0 THEN 'PRABC' WHEN 1 THEN 'TAM' || p_size WHEN 2 THEN 'x1' END AS c FROM part)
SELECT p_type, count(*) AS n_rows, count(*) FILTER (WHERE c = 'PRABC') AS registration, count(*) FILTER (WHERE c LIKE 'TAM%') AS airline, count(*) FILTER (WHERE c IS NULL OR c = 'x1') AS other FROM p GROUP BY ALL""")
def _(t):
    size = F.col("p_size")
    call = F.when(size % 4 == 0, "PRABC").when(size % 4 == 1, F.concat(F.lit("TAM"), size)).when(size % 4 == 2, "x1")
    return compare.traffic_classes(t("part").withColumn("c", call), ("p_type",), "c")


@bind("traffic_scopes", """WITH p AS (SELECT p_type, CASE WHEN p_size % 3 = 0 THEN 'none' WHEN p_size % 2 = 0 THEN 'domestic' ELSE 'international' END AS s FROM part)
SELECT p_type, count(*) AS n_rows, count(*) FILTER (WHERE s = 'domestic') AS domestic, count(*) FILTER (WHERE s = 'international') AS international, count(*) FILTER (WHERE s = 'none') AS no_aerodrome, round(100.0 * count(*) FILTER (WHERE s = 'international') / count(*), 1) AS pct_international FROM p GROUP BY ALL""")
def _(t):
    size = F.col("p_size")
    ends = {"dep": F.when(size % 3 == 0, "ZZZZ").otherwise("SBGR"), "arr": F.when(size % 2 == 0, "SBSP").otherwise("EGLL")}
    return compare.scopes(t("part").withColumns(ends), ("p_type",), "dep", "arr")


@bind("busiest_values", """WITH v AS (SELECT l_returnflag, unnest([l_partkey, l_suppkey]) AS value FROM lineitem), c AS (SELECT l_returnflag, value, count(*) AS n_rows FROM v GROUP BY ALL)
SELECT l_returnflag, value, n_rows FROM c QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY n_rows DESC, value) <= 10""")
def _(t):
    return compare.busiest(t("lineitem"), ("l_returnflag",), ("l_partkey", "l_suppkey"))


@bind("source_summary", f"""WITH {VERSIONS_SQL}, lf AS (SELECT * FROM lv QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1), rf AS (SELECT * FROM rv QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1),
n AS (SELECT (SELECT count(*) FROM lv) AS rows_left, (SELECT count(*) FROM rv) AS rows_right, (SELECT count(*) FROM lf) AS keys_left, (SELECT count(*) FROM rf) AS keys_right, (SELECT count(*) FROM lf JOIN rf USING (o_custkey)) AS "both",
  (SELECT count(*) FROM lf l JOIN rf r USING (o_custkey) WHERE l.priority IS DISTINCT FROM r.priority OR l.o_orderstatus IS DISTINCT FROM r.o_orderstatus) AS field_diff)
SELECT rows_left, rows_right, keys_left, keys_right, rows_left - keys_left AS repeats_left, rows_right - keys_right AS repeats_right, "both", keys_left - "both" AS only_left, keys_right - "both" AS only_right, field_diff FROM n""")
def _(t):
    return compare.source_summary(*versions(t), ("o_custkey",), ("priority", "o_orderstatus"), ("o_orderkey",))


@bind("difference_profile", f"WITH {ONLY_SQL}, u AS (SELECT * FROM ol UNION ALL SELECT * FROM orr) SELECT o_orderstatus AS \"group\", count(*) FILTER (WHERE side = 'left') AS only_left, count(*) FILTER (WHERE side = 'right') AS only_right FROM u GROUP BY ALL")
def _(t):
    return compare.difference_profile(*versions(t), K, F.col("o_orderstatus"))


@bind("taxi_field_diffs", """WITH e AS (SELECT event_id, upper(event_type) AS a, strftime(ts, '%Y-%m-%d %H:%M:%S') AS s FROM events)
SELECT f AS field, count(*) AS n, round(100.0 * sum(d) / count(*), 4) AS pct_different, round(100.0 * sum(ol) / count(*), 4) AS pct_only_left, 0.0::DOUBLE AS pct_only_right
FROM (SELECT 'box' AS f, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS d, 0 AS ol FROM e UNION ALL SELECT 'dh_vra', CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END FROM e UNION ALL SELECT 'match_vra', CASE WHEN event_id % 4 = 2 THEN 1 ELSE 0 END, 0 FROM e) GROUP BY f""")
def _(t):
    e, say = F.col("event_id"), lambda p: F.date_format("ts", p)
    base = lambda stamped: t("events").select(F.col("event_id").cast("string").alias("indicativo"), F.col("event_type").alias("mov"), stamped.alias("dh_bimtra"), F.lit("A").alias("adpartida"), F.lit("B").alias("addestino"), "event_id", "ts")
    left = base(say("yyyy-MM-dd'T'HH:mm:ss")).withColumns({"box": F.lit(" b1"), "dh_vra": say("yyyy-MM-dd'T'HH:mm:ss"), "match_vra": F.when(e % 2 == 0, "t").otherwise("Sim")})
    right = base(say("yyyy-MM-dd HH:mm:ss")).withColumns({"box": F.when(e % 5 == 0, "B2").otherwise("B1"), "dh_vra": F.when(e % 3 != 0, say("yyyy-MM-dd HH:mm:ss.SSS")), "match_vra": F.when(e % 4 == 2, "FALSE").otherwise("true")})
    return compare.differing_fields(taxi.comparison_key(left), taxi.comparison_key(right), ("key",), ("box", "dh_vra", "match_vra"), ("key",))


# --- hot keys cut by time: the same results --------------------------------------------------------------------------


@bind("islands_merge_split", f"WITH {VISITS_SQL} {MERGED_SQL}")
def _(t):
    return spelled(islands.merged(visits(t), replace(VISIT, split_by="day")))


@bind("islands_edges_split", EDGES_SQL)
def _(t):
    return rounded(islands.edges(visits(t), replace(VISIT, split_by="day"), "event_id"))


@bind("collapse_same_key_split", COLLAPSED_SQL)
def _(t):
    return collapsed(t, split=True)


@bind("numbered_split", "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber) AS seq FROM lineitem")
def _(t):
    rows = t("lineitem").select("l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber")
    out = dedup.numbered(rows, ("l_returnflag",), [F.col(c).asc() for c in ("l_shipdate", "l_orderkey", "l_linenumber")], split=True)
    return out.select("l_orderkey", "l_linenumber", F.col("seq").cast("long").alias("seq"))


@bind("nearest_one_to_one_split", f"WITH {NEAR_SQL} SELECT user_id, left_id, right_id, round(d, 4) AS diff_min FROM m")
def _(t):
    return rounded(nearest.match(purchases(t), clicks(t), replace(MATCH, split_by="day")).select("user_id", "left_id", "right_id", "diff_min"))


@bind("near_pairs_split", f"WITH {PAIRS_SQL} SELECT l AS row_id, r AS partner_id, round(gap, 4) AS gap_min, kind FROM pairs")
def _(t):
    return rounded(nearpairs.near_pairs(records(t), ("user_id",), "event_id", "s", "e", "reg", near_min=60.0, split_by="day"))


# --- duplicates, counts, samples ----------------------------------------------------------------------------------


@bind("duplicate_summary", f"""WITH {PAIRS_SQL}, fl AS (SELECT l, max(CASE WHEN kind = 'plan + movement' THEN 1 ELSE 0 END) AS plan_pair FROM pairs GROUP BY l),
d AS (SELECT f.*, event_type AS types, props, fl.l IS NOT NULL AS near, plan_pair, strftime(s, '%H:%M:%S') = '00:00:00' AND strftime(e, '%H:%M:%S') = '00:00:00' AS no_time FROM f JOIN (SELECT event_id, event_type, props FROM events) USING (event_id) LEFT JOIN fl ON fl.l = f.event_id),
k AS (SELECT types, sum(n - 1)::BIGINT AS same_key FROM (SELECT types, props, count(*) AS n FROM d GROUP BY ALL) GROUP BY ALL),
c AS (SELECT types, count(*) AS n_rows, count(*) FILTER (WHERE near) AS near, count(*) FILTER (WHERE near AND plan_pair = 1) AS near_plan, count(*) FILTER (WHERE near AND plan_pair = 0) AS near_repeat, count(*) FILTER (WHERE reg IS NULL) AS no_registration,
  count(*) FILTER (WHERE plan) AS plan_rows, count(*) FILTER (WHERE no_time) AS no_time FROM d GROUP BY ALL)
SELECT c.*, no_time AS untestable, same_key, round(100.0 * near / n_rows, 3) AS pct_near, round(100.0 * no_registration / n_rows, 1) AS pct_no_registration, round(100.0 * plan_rows / n_rows, 1) AS pct_plan, round(100.0 * no_time / n_rows, 1) AS pct_no_time,
  round(100.0 * (1 - no_time / n_rows), 1) AS pct_tested, no_time / n_rows > 0.9 AS suspicious FROM c JOIN k USING (types)""")
def _(t):
    return nearpairs.duplicate_summary(records(t), record_pairs(t), ("types",), "props", "event_id", "s", "e", "reg")


@bind("drop_repeated_key", """WITH l AS (SELECT CASE WHEN l_linenumber < 4 THEN l_orderkey END AS k, * FROM lineitem)
SELECT k, l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS n FROM l WHERE k IS NOT NULL) WHERE n = 1 UNION ALL SELECT k, l_orderkey, l_linenumber, l_partkey FROM l WHERE k IS NULL""")
def _(t):
    rows = t("lineitem").withColumn("k", F.when(F.col("l_linenumber") < 4, F.col("l_orderkey")))
    return dedup.keep_one(rows, ("k",), ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"), null_key="keep").select("k", "l_orderkey", "l_linenumber", "l_partkey")


@bind("pair_examples", f"""WITH {PAIRS_SQL}, h AS (SELECT DISTINCT user_id FROM f JOIN pairs ON event_id = l ORDER BY user_id LIMIT 5)
SELECT event_id, user_id, event_id IN (SELECT l FROM pairs) AS flagged, round((epoch_us(s) - epoch_us(lag(s) OVER (PARTITION BY user_id ORDER BY s, event_id))) / 60e6, 4) AS gap_min FROM f JOIN h USING (user_id)""")
def _(t):
    return rounded(nearpairs.examples(records(t), record_pairs(t), ("user_id",), "event_id", "s").select("event_id", "user_id", "flagged", "gap_min"))


@bind("count_by", """SELECT 'orders' AS source, year(o_orderdate)::INTEGER AS year, o_orderstatus AS status, NULL::VARCHAR AS flag, count(*) AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'lines', year(l_shipdate)::INTEGER, NULL, l_returnflag, count(*) FROM lineitem GROUP BY ALL""")
def _(t):
    o, lines = t("orders").withColumnsRenamed({"o_orderdate": "d", "o_orderstatus": "status"}), t("lineitem").withColumnsRenamed({"l_shipdate": "d", "l_returnflag": "flag"})
    return coverage.count_by({"orders": o, "lines": lines, "parts": t("part")}, "d", ("status", "flag"))


@bind("traffic_profile", """WITH p AS (SELECT p_type, p_size % 3 AS r, p_size % 5 AS k, p_size % 7 AS m FROM part)
SELECT p_type, count(*) AS n, round(100.0 * count(*) FILTER (WHERE r = 0) / count(*), 4) AS pct_ifr, round(100.0 * count(*) FILTER (WHERE r = 1) / count(*), 4) AS pct_vfr, round(100.0 * count(*) FILTER (WHERE k = 0) / count(*), 4) AS pct_scheduled,
  round(100.0 * count(*) FILTER (WHERE k = 1) / count(*), 4) AS pct_general, round(100.0 * count(*) FILTER (WHERE m < 2) / count(*), 4) AS pct_no_aerodrome FROM p GROUP BY ALL""")
def _(t):
    s = F.col("p_size")
    said = {"li_regravoo": F.when(s % 3 == 0, "I|V").when(s % 3 == 1, "V"), "li_tipovoo": F.when(s % 5 == 0, "S").when(s % 5 == 1, "G|S").otherwise("M"), "co_addep": F.when(s % 7 == 0, "ZZZZ").otherwise("SBGR"), "co_addes": F.when(s % 7 == 1, " ").otherwise("SBSP")}
    return flights.traffic_profile(t("part").withColumns(said), ("p_type",))


@bind("written_period", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1995, 1997) AND month(o_orderdate) IN (1, 2, 12) GROUP BY ALL")
def _(t):
    return t("orders").where(time.in_written_period(F.col("o_orderdate"), (1995, 1997), (1, 2, 12))).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@bind("sampled_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('0|' || o_orderkey), o_orderkey LIMIT 100")
def _(t):
    return dedup.sampled(t("orders"), ("o_orderkey",), 100).select("o_orderkey", "o_custkey")


# --- plans: raw text to daily sums ---------------------------------------------------------------------------------

DAILY_SQL = """, ref AS (SELECT {key}, quantile_cont(q, 0.2) AS reference FROM r WHERE {valid} AND {whole} AND w BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-12-31 23:59:59' GROUP BY ALL HAVING count(*) >= 5),
v AS (SELECT r.*, reference, coalesce({valid}, false) AND reference IS NOT NULL AS valid FROM r LEFT JOIN ref USING ({key}))
SELECT {by}, strftime(d, '%Y-%m-%d') AS "DATE", count(*) FILTER (WHERE valid) AS "MVTS_VALID", count(*) FILTER (WHERE NOT valid) AS "MVTS_NA", round(coalesce(sum(q) FILTER (WHERE valid), 0), 4)::DOUBLE AS {total},
  round(coalesce(sum(reference) FILTER (WHERE valid), 0), 4) AS "TOT_REF", round(coalesce(sum(q - reference) FILTER (WHERE valid), 0), 4) AS "TOT_ADD_TIME" FROM v GROUP BY ALL"""


def text_of(stamped: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.coalesce(F.date_format(stamped, pattern), F.lit(""))


@bind("taxi_daily", """WITH r AS (SELECT CASE l_returnflag WHEN 'R' THEN 'ARR' WHEN 'A' THEN 'DEP' END AS "PHASE", CASE l_returnflag WHEN 'R' THEN 'D' || (l_partkey % 3) WHEN 'A' THEN 'S' || (l_suppkey % 4) END AS "ICAO", 'B' || (l_linenumber % 3) AS stnd, nullif(l_linestatus, 'F') AS rwy,
  CASE WHEN l_linenumber <> 7 THEN l_shipdate + to_minutes(CAST(CASE WHEN l_returnflag = 'A' THEN -l_quantity ELSE l_quantity END AS BIGINT)) END AS w, CASE WHEN l_linenumber <> 7 AND l_returnflag <> 'N' THEN l_quantity END AS q, coalesce(w, l_shipdate)::DATE AS d FROM lineitem)"""
      + DAILY_SQL.format(key='"ICAO", "PHASE", stnd, rwy', valid="q > 0 AND q <= 120", whole='"ICAO" IS NOT NULL AND rwy IS NOT NULL', by='"ICAO", "PHASE"', total='"TOT_TXXT"'))
def _(t):
    m, q, flag = F.col("l_shipdate").cast("timestamp"), F.col("l_quantity").cast("long"), F.col("l_returnflag")
    block = F.when(F.col("l_linenumber") != 7, F.timestamp_micros(F.unix_micros(m) + F.when(flag == "A", -q).otherwise(q) * 60_000_000))
    raw = t("lineitem").select(
        F.when(flag == "R", "Arr").when(flag == "A", " Dep").otherwise("XXX").alias("mov"), text_of(m, "yyyy-MM-dd'T'HH:mm:ss").alias("dh_bimtra"), text_of(block).alias("dh_vra"), F.concat(F.lit("B"), F.col("l_linenumber") % 3, F.lit("\t")).alias("box"),
        F.when(F.col("l_linestatus") == "F", " ").otherwise(F.col("l_linestatus")).alias("pista"), F.concat(F.lit("S"), F.col("l_suppkey") % 4).alias("adpartida"), F.concat(F.lit("D"), F.col("l_partkey") % 3).alias("ADDESTINO"),
    )
    return rounded(taxi.daily(taxi.harmonised(raw), 1997)).withColumn("DATE", F.col("DATE").cast("string"))


@bind("terminal_daily", """WITH r AS (SELECT 'D' || (l_partkey % 3) AS "ICAO", 'ARR' AS "PHASE", CASE l_linenumber % 3 WHEN 0 THEN 'C40' ELSE 'C100' END AS "RANGE", l_returnflag AS "CLASS", l_linestatus AS "RWY", 'S' || lpad((l_suppkey % 4)::VARCHAR, 3, '0') AS "SECTOR_GROUP", l_shipdate AS w, l_quantity AS q, l_shipdate::DATE AS d
  FROM lineitem WHERE l_linenumber % 3 < 2)""" + DAILY_SQL.format(key='"ICAO", "PHASE", "RANGE", "CLASS", "RWY", "SECTOR_GROUP"', valid="q > 0 AND q <= 180", whole="true", by='"ICAO", "PHASE", "RANGE", "CLASS", "RWY", "SECTOR_GROUP"', total='"TOT_TRANSIT"'))  # fmt: skip
def _(t):
    m, q, line = F.col("l_shipdate").cast("timestamp"), F.col("l_quantity").cast("long"), F.col("l_linenumber")
    cross = F.when(line != 7, F.timestamp_micros(F.unix_micros(m) - q * 60_000_000))
    raw = t("lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"), F.concat(F.lit("D"), F.col("l_partkey") % 3).alias("ades"), F.col("l_returnflag").alias("class"), F.when(line % 2 == 0, " ").otherwise(F.col("l_linestatus")).alias("drwy_validado"), F.col("l_linestatus").alias("drwy"), text_of(m).alias("aldt"),
        F.when(line % 3 == 0, "40").when(line % 3 == 1, "100").otherwise("60").alias("c"), text_of(cross).alias("c_time"), (F.col("l_suppkey") % 4).cast("string").alias("setor"), F.format_string("0:%02d:00", q).alias("transito"),
    )
    out = rounded(terminal.daily(terminal.harmonised(raw), 1997)).withColumn("DATE", F.col("DATE").cast("string"))
    return out.drop("TOT_SUPPLIED_REF", "TOT_SUPPLIED_ADD")


# --- sources and sinks: written, and read back --------------------------------------------------------------------


def spark_of(df: DataFrame):
    return df.sparkSession


@bind("delimited_round_trip", "SELECT o_orderkey::VARCHAR AS id, nullif(o_orderpriority, '5-LOW') AS priority, strftime(o_orderdate, '%Y-%m-%d') AS day, '; ' || o_orderstatus || '\"' AS odd FROM orders")
def _(t):
    out = t("orders").select(F.col("o_orderkey").cast("string").alias("id"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.concat(F.lit("; "), "o_orderstatus", F.lit('"')).alias("odd"))
    path = files.scratch(spark_of(out), "delimited")
    files.write_delimited(out, path)
    return delimited.read_delimited(spark_of(out), path, ["id", "priority", "day", "odd"])


@bind("audit_round_trip", f"WITH {ONLY_SQL} SELECT side, o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey FROM ol UNION ALL SELECT side, o_orderkey::VARCHAR, o_custkey::VARCHAR FROM orr")
def _(t):
    out = compare.unmatched(*versions(t), K).select(*ONLY)
    path = files.scratch(spark_of(out), "audit")
    files.write_audit(out, path, ("side", "o_orderkey"))
    return delimited.read_delimited(spark_of(out), path, list(ONLY))


@bind("typed_file_round_trip", "SELECT p_partkey, nullif(p_size, 7)::INTEGER AS size, round(p_retailprice, 2) AS price FROM part")
def _(t):
    out = t("part").select("p_partkey", F.nullif(F.col("p_size"), F.lit(7)).alias("size"), F.round("p_retailprice", 2).alias("price"))
    path = files.scratch(spark_of(out), "typed")
    files.write_delimited(out, path, sep=",", quote_all=False, null="NA")
    return delimited.read_typed(spark_of(out), path, "p_partkey long, size int, price double")


@bind("yearly_parquet_period", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS ordered FROM orders WHERE year(o_orderdate) = 1996")
def _(t):
    orders = t("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    path = files.scratch(spark_of(orders), "yearly")
    files.write_by_year(orders, path, F.year("o_orderdate"))
    return parquet.read_period(spark_of(orders), path, "o_orderdate", 1996, columns=["o_orderkey", "o_orderdate", "absent"]).select("o_orderkey", stamp(F.col("o_orderdate")).alias("ordered"))


@bind("year_replaced", "SELECT o_orderkey, year(o_orderdate)::INTEGER AS \"YEAR\", CASE WHEN year(o_orderdate) = 1996 THEN 'new' ELSE o_orderstatus END AS status FROM orders")
def _(t):
    orders = t("orders").select("o_orderkey", F.year("o_orderdate").alias("YEAR"), F.col("o_orderstatus").alias("status"))
    path = files.scratch(spark_of(orders), "replaced")
    files.write_by_year(orders, path, "YEAR")
    files.write_by_year(orders.where("YEAR = 1996").withColumn("status", F.lit("new")), path, "YEAR")
    return spark_of(orders).read.parquet(path).select("o_orderkey", "YEAR", "status")


MONTHS_SQL = """WITH o AS (SELECT o_custkey, o_orderdate, o_orderkey, strftime(o_orderdate, '%Y-%m') AS m FROM orders),
k AS (SELECT *, row_number() OVER (PARTITION BY m, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM o)"""


def stored_months(t: Reader, extra: tuple[str, ...] = ()):
    """A month table of all orders, of which one month is then fetched again without a row; (the table, its months)."""
    orders = t("orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"), *extra)
    spark = spark_of(orders)
    table = incremental.IncrementalTable(spark, files.scratch(spark, "months"), "ts", ("o_custkey", "year", "month"), ("ts", "o_orderkey"))
    months = sorted({(r.y, r.m) for r in orders.select(F.year("ts").alias("y"), F.month("ts").alias("m")).distinct().collect()} | {(1996, 2)})
    table.store(orders, months, "1999-01-01")
    table.store(orders.limit(0), [(1996, 2)], "1999-01-02")
    return table, months


@bind("month_table", f"{MONTHS_SQL} SELECT o_custkey, o_orderkey, m AS month_of FROM k WHERE n = 1 AND m <> '1996-02'")
def _(t):
    return stored_months(t)[0].rows().select("o_custkey", "o_orderkey", F.date_format("ts", "yyyy-MM").alias("month_of"))


@bind("month_table_by_version", f"{MONTHS_SQL} SELECT v.v AS version, o_custkey, o_orderkey FROM k, (VALUES (0), (1)) AS v(v) WHERE n = 1 AND (v.v = 0 OR m <> '1996-02')")
def _(t):
    table, _ = stored_months(t)
    return table.rows(0).select(F.lit(0).alias("version"), "o_custkey", "o_orderkey").unionByName(table.rows(1).select(F.lit(1).alias("version"), "o_custkey", "o_orderkey"))


@bind("month_manifest", f"{MONTHS_SQL}, c AS (SELECT m, count(*) AS n, count(DISTINCT o_orderdate::DATE) AS days FROM k WHERE n = 1 GROUP BY m) SELECT m AS month_of, CASE WHEN m = '1996-02' THEN 0 ELSE n END AS n, CASE WHEN m = '1996-02' THEN 0 ELSE days END AS days, CASE WHEN m = '1996-02' THEN '1999-01-02' ELSE '1999-01-01' END AS checked_at FROM c")
def _(t):
    return stored_months(t)[0].manifest().select(F.format_string("%04d-%02d", "year", "month").alias("month_of"), "n", F.col("days").cast("long").alias("days"), "checked_at")


@bind("refetched_months", """WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders), n AS (SELECT o_orderkey, o_custkey, o_orderdate, 'new' AS o_orderstatus FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1996-02' AND o_custkey % 2 = 0)
SELECT o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, o_custkey DESC, o_orderstatus DESC) AS k FROM (SELECT * FROM o WHERE strftime(o_orderdate, '%Y-%m') <> '1996-02' UNION ALL SELECT * FROM n)) WHERE k = 1""")
def _(t):
    old = t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    new = old.where((F.date_format("o_orderdate", "yyyy-MM") == "1996-02") & (F.col("o_custkey") % 2 == 0)).withColumn("o_orderstatus", F.lit("new"))
    periods = spark_of(old).createDataFrame([(1996, 2)], "year int, month int")
    return incremental.merged_update(old, new, periods, "o_orderdate", ("o_orderkey",), ("o_orderdate", "o_custkey", "o_orderstatus")).select("o_orderkey", "o_orderstatus")


@bind("prepared_months", "SELECT strftime(o_orderdate, '%Y-%m') AS month_of, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-04-01' GROUP BY ALL")
def _(t):
    orders = t("orders")
    spark = spark_of(orders)
    path = files.scratch(spark, "prepared")
    prepare = lambda year, month: orders.where((F.year("o_orderdate") == year) & (F.month("o_orderdate") == month))
    for as_of in (date(1996, 3, 20), date(1996, 4, 2)):  # the second run writes March alone
        incremental.prepare_months(spark, path, prepare, (1996,), as_of)
    return spark.read.parquet(path).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month_of")).agg(F.count("*").alias("n"))


@bind("stream_month_refresh", "SELECT event_id, 2 AS version FROM events")
def _(t):
    events = t("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    spark = spark_of(events)
    parts, path, checkpoint = (files.scratch(spark, n) for n in ("stream-parts", "stream-months", "stream-checkpoint"))
    for version in (1, 2):  # each row is served twice, in files of its own
        events.withColumn("version", F.lit(version)).write.mode("append").parquet(parts)
        stream = spark.readStream.schema("event_id long, ts timestamp, version int").parquet(parts)
        sessions.refresh_months(stream, "ts", path, checkpoint).trigger(availableNow=True).start().awaitTermination()
    return sessions.refreshed(spark.read.parquet(path), ("event_id",), ("version",)).select("event_id", "version")


@bind("stream_daily_counts", "SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL")
def _(t):
    out = sessions.daily_counts(t("events"), "ts", ("event_type",), "1 day")
    return out.withColumn("day", F.col("day").cast("string"))



# --- references from stored counts, windows scored, sides stored, files counted ---------------------------------------

WINDOWS = {"year": ("1997-01-01 00:00:00", "1997-12-31 23:59:59"), "half": ("1996-07-01 00:00:00", "1996-12-31 23:59:59"), "days": ("1996-02-10 00:00:00", "1996-03-09 23:59:59"), "all": None}
STATE_SQL = """WITH legs AS (SELECT l_returnflag, o_orderpriority, o_orderdate, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) + CASE WHEN strftime(o_orderdate, '%Y-%m') = '1996-02' THEN 3 ELSE 0 END AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
w(name, low, high) AS (VALUES ('year', TIMESTAMP '1997-01-01', TIMESTAMP '1997-12-31 23:59:59'), ('half', TIMESTAMP '1996-07-01', TIMESTAMP '1996-12-31 23:59:59'), ('days', TIMESTAMP '1996-02-10', TIMESTAMP '1996-03-09 23:59:59'), ('all', TIMESTAMP '1900-01-01', TIMESTAMP '2100-01-01'))
SELECT name AS window, l_returnflag, o_orderpriority, count(*) AS n, round(quantile_cont(days, 0.2), 4) AS reference FROM legs JOIN w ON o_orderdate BETWEEN low AND high WHERE days > 0 AND days <= 120 GROUP BY ALL HAVING count(*) >= 5"""


@bind("reference_from_state", STATE_SQL)
def _(t):
    """Four windows from stored counts, of which one month was fetched again with other durations."""
    rows = legs(t).select(*LEG_KEY, "ordered", "days")
    spark = spark_of(rows)
    state = refstate.ReferenceState(spark, files.scratch(spark, "reference-state"), LEG_SPEC)
    months = sorted({(r.y, r.m) for r in rows.select(F.year("ordered").alias("y"), F.month("ordered").alias("m")).distinct().collect()} | {(1996, 2)})
    state.update(rows, months)
    state.update(rows.where((F.year("ordered") == 1996) & (F.month("ordered") == 2)).withColumn("days", F.col("days") + 3), [(1996, 2)])
    out = [state.reference(window).select(F.lit(name).alias("window"), "*") for name, window in WINDOWS.items()]
    return rounded(reduce(DataFrame.unionByName, out))


SCORES_SQL = f"""WITH r AS (SELECT l_returnflag AS flag, strftime(l_shipdate, '%Y-%m') AS month, l_shipdate, l_quantity FROM lineitem),
g AS (SELECT flag, month, sum(l_quantity)::DOUBLE AS total FROM r GROUP BY ALL),
c AS (SELECT 'all' AS candidate, flag, month, sum(l_quantity)::DOUBLE AS total FROM r GROUP BY ALL UNION ALL SELECT 'first_half', flag, month, sum(l_quantity)::DOUBLE FROM r WHERE day(l_shipdate) <= 15 GROUP BY ALL UNION ALL SELECT 'to_27th', flag, month, sum(l_quantity)::DOUBLE FROM r WHERE day(l_shipdate) <= 27 GROUP BY ALL)
SELECT k.candidate, count(*) AS n, count(*) FILTER (WHERE abs(g.total - c.total) < 1e-6) AS total_ok FROM g CROSS JOIN (SELECT DISTINCT candidate FROM c) k LEFT JOIN c ON c.candidate = k.candidate AND c.flag = g.flag AND c.month = g.month GROUP BY ALL"""


@bind("window_scores", SCORES_SQL)
def _(t):
    rows = t("lineitem").select(F.col("l_returnflag").alias("flag"), F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.dayofmonth("l_shipdate").alias("day"), "l_quantity")
    sums = lambda df: df.groupBy("flag", "month").agg(F.sum("l_quantity").cast("double").alias("total"))
    candidates = {"all": sums(rows), "first_half": sums(rows.where("day <= 15")), "to_27th": sums(rows.where("day <= 27"))}
    return reconcile.score_windows(sums(rows), candidates, ("flag", "month"), ("total",))


@bind("stored_sides_unmatched", f"WITH {ONLY_SQL} SELECT side, o_orderkey, o_custkey FROM ol UNION ALL SELECT side, o_orderkey, o_custkey FROM orr")
def _(t):
    both = sides.StoredSides(*versions(t), K, buckets=8)
    return reduce(DataFrame.unionByName, [both.only(side).select(F.lit(side).alias("side"), "o_orderkey", "o_custkey") for side in ("left", "right")])


@bind("line_numbers", "SELECT o_orderkey::VARCHAR AS id, row_number() OVER (ORDER BY o_orderkey) AS line FROM orders")
def _(t):
    orders = t("orders").select(F.col("o_orderkey").cast("string").alias("id"), "o_orderkey", "o_orderstatus")
    path = files.scratch(spark_of(orders), "lines")
    files.write_delimited(orders.repartitionByRange(7, "o_orderkey").sortWithinPartitions("o_orderkey").drop("o_orderkey"), path)
    return delimited.numbered_lines(delimited.read_delimited(spark_of(orders), path, ["id", "status"], with_origin=True)).select("id", "line")


@bind("inventory_from_footers", "SELECT year(o_orderdate) AS year, count(*) AS rows, strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS first, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS last, year(o_orderdate) = 1995 AS scanned FROM orders GROUP BY ALL")
def _(t):
    """Orders by year, one file each; a year is written with stamps of the old kind, whose footers have no bounds."""
    orders = t("orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"))
    spark = spark_of(orders)
    path, kind = files.scratch(spark, "inventory"), "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(kind)
    for stored, rows in (("TIMESTAMP_MICROS", orders.where(F.year("ts") != 1995)), ("INT96", orders.where(F.year("ts") == 1995))):
        spark.conf.set(kind, stored)
        rows.withColumn("year", F.year("ts")).repartition("year").write.partitionBy("year").mode("append").parquet(path)
    spark.conf.set(kind, before)
    return catalog.footers(spark, path, "ts").select(F.regexp_extract("path", r"year=(\d+)", 1).cast("long").alias("year"), "rows", stamp(F.col("first")).alias("first"), stamp(F.col("last")).alias("last"), "scanned")


@bind("flight_steps", """WITH e AS (SELECT event_id, upper(trim(event_type)) AS cs, user_id % 20 AS dep, ts, 'K' || (event_id // 2) AS pk FROM events), k AS (SELECT pk, count(*) AS n, arg_min(cs, row(ts, event_id)) AS cs, arg_min(dep, row(ts, event_id)) AS dep, min(ts) AS s FROM e GROUP BY pk),
w AS (SELECT *, lag(s) OVER (PARTITION BY cs, dep ORDER BY s, pk) AS b FROM k), i AS (SELECT count(*) FILTER (WHERE b IS NULL OR epoch_us(s) - epoch_us(b) > 3600000000) AS flights, count(*) AS kept, sum(n)::BIGINT AS read FROM w)
SELECT read, read - kept AS collapsed, kept, kept - flights AS merged, flights AS out FROM i""")
def _(t):
    e = t("events")
    raw = e.select(F.concat(F.lit("K"), F.floor(F.col("event_id") / 2)).alias("pk"), F.col("event_type").alias("co_indicativo"), (F.col("user_id") % 20).cast("string").alias("co_addep"), F.lit("X").alias("co_addes"), F.col("ts").cast("timestamp").alias("dh_inicio"), F.col("ts").cast("timestamp").alias("dh_fim"))
    counted = flights.prepared_with_steps(raw)
    counted.frame.write.format("noop").mode("overwrite").save()
    return spark_of(e).createDataFrame([counted.steps], "read long, collapsed long, kept long, merged long, out long")


def streamed(t: Reader, table: str, parts: int, apply, name: str) -> DataFrame:
    """All changes of a stream over a table that comes in ``parts`` files, mixed in time, a micro-batch each."""
    rows = t(table)
    spark = spark_of(rows)
    source, out, checkpoint = (files.scratch(spark, f"{name}-{x}") for x in ("source", "changes", "checkpoint"))
    rows = apply(rows, None)
    rows.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.lit(parts))).repartition(parts, "_part").drop("_part").write.parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch_{number:06d}")

    with stateful.with_state_store(spark):
        stream = apply(None, spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source))
        stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.option("recursiveFileLookup", True).parquet(out)


@bind("stream_islands_merge", f"WITH {VISITS_SQL} {MERGED_SQL}")
def _(t):
    changes = streamed(t, "events", 3, lambda df, stream: visits(lambda _: df) if stream is None else stateful.merged_islands(stream, VISIT, "400 days"), "islands")
    return spelled(stateful.amended(changes, ("user_id", "island_id"), ("batch",)))


@bind("stream_keep_last", "SELECT user_id, max_by(event_id, row(ts, event_id)) AS event_id, max_by(event_type, row(ts, event_id)) AS event_type FROM events GROUP BY ALL")
def _(t):
    narrow = lambda df: df.select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    changes = streamed(t, "events", 3, lambda df, stream: narrow(df) if stream is None else stateful.keep_last(stream, ("user_id",), "ts", ("ts", "event_id"), "400 days", 400 * 86_400_000), "last")
    return stateful.amended(changes, ("user_id",), ("batch",)).select("user_id", "event_id", "event_type")
