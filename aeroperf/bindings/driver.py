"""The operators bound to the driver's tables, each with the SQL that says the same.

``bind(name, sql)`` registers a function of a table reader. Stamps leave as
text and floating results rounded, so that both engines spell them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroperf.config import KpiSpec, MatchSpec, MergeSpec
from aeroperf.functions import numbers, text, time
from aeroperf.operators import collapse, coverage, dedup, islands, kpi, nearest, nearpairs, reconcile, reshape
from aeroperf.streaming import sessions

Reader = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def bind(name: str, sql: str | None = None):
    def register(f: Callable[[Reader], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return register


def stamp(c: Column) -> Column:
    return F.date_format(c.cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")


STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"

# --- percentile-reference KPI -------------------------------------------------------------------------------------

LEG_KEY = ("l_returnflag", "o_orderpriority")
LEG_SPEC = KpiSpec(LEG_KEY, "days", "month", 120.0, window_col="ordered", window=("1997-01-01 00:00:00", "1997-12-31 23:59:59"))
LEGS_SQL = """
legs AS (SELECT l_returnflag, {priority} AS o_orderpriority, o_orderdate, strftime(l_shipdate, '%Y-%m') AS month, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ref AS (SELECT l_returnflag, o_orderpriority, count(*) AS n, quantile_cont(days, 0.2) AS reference FROM legs
  WHERE days > 0 AND days <= 120 AND o_orderpriority IS NOT NULL AND o_orderdate BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-12-31 23:59:59' GROUP BY ALL HAVING count(*) >= 5),
v AS (SELECT legs.*, reference, (days > 0 AND days <= 120 AND reference IS NOT NULL) AS valid FROM legs LEFT JOIN ref USING (l_returnflag, o_orderpriority))"""
LEGS, LEGS_NULL = LEGS_SQL.format(priority="o_orderpriority"), LEGS_SQL.format(priority="nullif(o_orderpriority, '5-LOW')")
SUMS = """count(*) FILTER (WHERE valid) AS "MVTS_VALID", count(*) FILTER (WHERE NOT valid) AS "MVTS_NA", round(coalesce(sum(days) FILTER (WHERE valid), 0), 4)::DOUBLE AS "TOT",
  round(coalesce(sum(reference) FILTER (WHERE valid), 0), 4) AS "TOT_REF", round(coalesce(sum(days - reference) FILTER (WHERE valid), 0), 4) AS "TOT_ADD" """


def legs(t: Reader, null_low: bool = False) -> DataFrame:
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")) if null_low else F.col("o_orderpriority")
    both = t("lineitem").select("l_orderkey", "l_returnflag", "l_shipdate").join(t("orders").select("o_orderkey", "o_orderdate", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select("l_returnflag", priority.alias("o_orderpriority"), F.col("o_orderdate").cast("timestamp").alias("ordered"), F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.datediff("l_shipdate", "o_orderdate").cast("double").alias("days"))


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"})


@bind("kpi_reference", f"WITH {LEGS} SELECT l_returnflag, o_orderpriority, n, round(reference, 4) AS reference FROM ref")
def _(t):
    return rounded(kpi.reference(legs(t), LEG_SPEC))


@bind("kpi_daily", f"WITH {LEGS} SELECT l_returnflag, o_orderpriority, month, {SUMS} FROM v GROUP BY ALL")
def _(t):
    return rounded(kpi.percentile_kpi(legs(t), LEG_SPEC, (*LEG_KEY, "month")))


@bind("kpi_daily_wide_key", f"WITH {LEGS_NULL} SELECT l_returnflag, o_orderpriority, month, {SUMS} FROM v GROUP BY ALL")
def _(t):
    return rounded(kpi.percentile_kpi(legs(t, True), LEG_SPEC, (*LEG_KEY, "month")))


@bind("kpi_coverage_rollup", f'WITH {LEGS}, d AS (SELECT *, substr(month, 1, 4) AS year FROM v) SELECT year, l_returnflag, {SUMS}, count(*) AS "MVTS_TOTAL" FROM d GROUP BY ALL')
def _(t):
    daily = kpi.percentile_kpi(legs(t), LEG_SPEC, (*LEG_KEY, "month"))
    return rounded(kpi.rolled_up(daily.withColumn("year", F.substring("month", 1, 4)), ("year", "l_returnflag")))


@bind("kpi_reference_coverage", f'WITH {LEGS}, g AS (SELECT l_returnflag, o_orderpriority, count(*) AS n FROM legs WHERE days > 0 AND days <= 120 AND o_orderdate BETWEEN TIMESTAMP \'1997-01-01\' AND TIMESTAMP \'1997-12-31 23:59:59\' GROUP BY ALL) SELECT l_returnflag, count(*) AS "N_REFERENCE_GROUPS", count(*) FILTER (WHERE n >= 5) AS "N_VALID_REFERENCE_GROUPS" FROM g GROUP BY ALL')
def _(t):
    return kpi.reference_coverage(kpi.reference(legs(t), LEG_SPEC, keep_small=True), ("l_returnflag",), 5)


@bind("kpi_ring_caps", """
SELECT l_linestatus AS ring, count(*) AS n, count(*) FILTER (WHERE l_quantity > 0 AND l_quantity <= CASE l_linestatus WHEN 'O' THEN 20 WHEN 'F' THEN 40 END) AS n_valid FROM lineitem GROUP BY ALL""")
def _(t):
    valid = kpi.is_valid(KpiSpec(("ring",), "l_quantity", "", cap_by=("ring", {"O": 20.0, "F": 40.0})))
    return t("lineitem").withColumnRenamed("l_linestatus", "ring").groupBy("ring").agg(F.count("*").alias("n"), numbers.count_if(valid).alias("n_valid"))


@bind("null_audit", """
WITH o AS (SELECT o_orderstatus, nullif(o_orderpriority, '1-URGENT') AS priority, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS cust, o_totalprice FROM orders)
SELECT o_orderstatus, count(*) AS "N_TOTAL", count(*) FILTER (WHERE o_totalprice > 1000) AS "N_VALID", count(*) - count(priority) AS "N_MISSING_priority", count(*) - count(cust) AS "N_MISSING_cust",
  round(100.0 * count(*) FILTER (WHERE o_totalprice > 1000) / count(*), 2) AS "PCT_VALID" FROM o GROUP BY ALL""")
def _(t):
    o = t("orders").withColumns({"priority": F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")), "cust": F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey"))})
    return kpi.null_audit(o, ("o_orderstatus",), ("priority", "cust"), F.col("o_totalprice") > 1000)


@bind("avg_share_rollup", """
SELECT l_returnflag, l_linestatus, grouping(l_returnflag, l_linestatus)::BIGINT AS grain, round(sum(l_tax::DECIMAL(18, 4)) / sum(l_quantity::DECIMAL(18, 4)), 4)::DOUBLE AS tax_per_unit, round(sum(l_discount::DECIMAL(18, 4)) / sum(l_quantity::DECIMAL(18, 4)), 4)::DOUBLE AS discount_per_unit
FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())""")
def _(t):
    return kpi.ratio_grains(t("lineitem"), [("l_returnflag", "l_linestatus"), ("l_returnflag",), ()], {"tax_per_unit": ("l_tax", "l_quantity"), "discount_per_unit": ("l_discount", "l_quantity")})


@bind("level_comparability", f"""
WITH {LEGS}, m AS (SELECT l_returnflag, year(o_orderdate) AS year, count(*) AS n, median(days)::DOUBLE AS median FROM legs WHERE days > 0 AND days <= 120 GROUP BY ALL),
b AS (SELECT l_returnflag, median AS base_median FROM m WHERE year = 1997)
SELECT m.l_returnflag, year, n, median, base_median, median - base_median AS difference, coalesce(abs(median - base_median) <= 1.0, false) AS comparable FROM m LEFT JOIN b USING (l_returnflag)""")
def _(t):
    df = legs(t).where(kpi.is_valid(LEG_SPEC)).withColumn("year", F.year("ordered").cast("long"))
    return kpi.comparability(df, ("l_returnflag",), "year", 1997, "days", 1.0)


@bind("percentile_vector", """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.75), 4) AS p75, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99 FROM lineitem GROUP BY ALL""")
def _(t):
    return rounded(kpi.percentiles(t("lineitem"), ("l_returnflag",), "l_extendedprice", (0.25, 0.5, 0.75, 0.99)))


# --- duplicates and merges ----------------------------------------------------------------------------------------

LINE = ("l_orderkey", "l_linenumber")
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
KEEP_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice, 2) AS price FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate {d}, l_partkey {d}, l_suppkey {d}, l_quantity {d}, l_extendedprice {d}, l_discount {d}, l_tax {d}, l_returnflag {d}, l_linestatus {d}) AS n FROM lineitem) WHERE n = 1"""


@bind("top_values", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL ORDER BY n DESC, o_custkey LIMIT 10")
def _(t):
    return t("orders").groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(10)


@bind("dup_surplus", "WITH k AS (SELECT l_returnflag, l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL) SELECT l_returnflag, sum(n)::BIGINT AS n_rows, count(*) AS n_keys, sum(n - 1)::BIGINT AS n_surplus FROM k GROUP BY ALL")
def _(t):
    return dedup.surplus(t("lineitem"), ("l_returnflag",), LINE)


@bind("dedup_keep_first", KEEP_SQL.format(d=""))
def _(t):
    return dedup.keep_one(t("lineitem"), LINE, LINE_ORDER).select(*LINE, "l_partkey", F.round("l_extendedprice", 2).alias("price"))


@bind("dedup_keep_last", KEEP_SQL.format(d="DESC"))
def _(t):
    return dedup.keep_one(t("lineitem"), LINE, LINE_ORDER, last=True).select(*LINE, "l_partkey", F.round("l_extendedprice", 2).alias("price"))


@bind("exact_row_distinct", "SELECT min(doc_id) AS doc_id, lang, source, n_chars, length(text) AS n FROM documents GROUP BY text, lang, source, n_chars")
def _(t):
    return dedup.distinct_rows(t("documents"), ("doc_id",)).select("doc_id", "lang", "source", "n_chars", F.length("text").cast("long").alias("n"))


@bind("duplicate_roles", """
SELECT l_orderkey, l_linenumber, l_partkey, group_size, CASE WHEN n = 1 THEN 'original' ELSE 'repeat' END AS role FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS group_size,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS n FROM lineitem) WHERE group_size > 1""")
def _(t):
    return dedup.group_roles(t("lineitem"), LINE, LINE_ORDER).select(*LINE, "l_partkey", "group_size", "role")


@bind("rotation_seq_key", "SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate NULLS LAST, o_orderkey NULLS LAST) AS seq FROM orders")
def _(t):
    df = t("orders").withColumn("y", F.year("o_orderdate"))
    return dedup.numbered(df, ("o_custkey", "y"), [F.col("o_orderdate").asc_nulls_last(), F.col("o_orderkey").asc_nulls_last()]).select("o_orderkey", "o_custkey", F.col("seq").cast("long").alias("seq"))


FILLED = "arg_min({0}, ({1})) FILTER (WHERE {0} IS NOT NULL AND trim({0}::VARCHAR) <> '')"


COLLAPSED_SQL = f"""
WITH r AS (SELECT CASE WHEN l_orderkey % 11 <> 0 THEN CASE WHEN l_quantity > 25 THEN 'k' ELSE 'K' END || l_orderkey || '-' || l_linenumber END AS k, l_returnflag || ', ' || l_linestatus || '|' AS flags,
  CASE WHEN l_discount > 0.02 THEN l_discount END AS discount, l_partkey, row(l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS o FROM lineitem),
m AS (SELECT arg_min(k, o) AS k, array_to_string(list_sort(list_distinct(list_filter(flatten(list(list_transform(string_split_regex(flags, '[|,]'), lambda x: trim(x)))), lambda x: x <> ''))), '|') AS flags,
  arg_min(discount, o) FILTER (WHERE discount IS NOT NULL) AS discount, arg_min(l_partkey, o) AS l_partkey, count(*) AS "N_KEY_MERGED" FROM r WHERE k IS NOT NULL GROUP BY upper(k))
SELECT * FROM m UNION ALL SELECT k, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split_regex(flags, '[|,]'), lambda x: trim(x)), lambda x: x <> ''))), '|'), discount, l_partkey, 1 FROM r WHERE k IS NULL"""


def collapsed(t: Reader, split: bool = False) -> DataFrame:
    key = F.when(F.col("l_orderkey") % 11 != 0, F.concat(F.when(F.col("l_quantity") > 25, "k").otherwise("K"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")))
    order = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    df = t("lineitem").select(key.alias("k"), F.concat("l_returnflag", F.lit(", "), "l_linestatus", F.lit("|")).alias("flags"), F.when(F.col("l_discount") > 0.02, F.col("l_discount")).alias("discount"), *order)
    return collapse.collapse_same_key(df, "k", order, ("flags",), split=split).select("k", "flags", "discount", "l_partkey", "N_KEY_MERGED")


@bind("collapse_same_key", COLLAPSED_SQL)
def _(t):
    return collapsed(t)


@bind("canonical_list", """
SELECT p_partkey, nullif(array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split_regex(replace(p_name, ' ', ' , ') || '|' || p_type || '|' || p_name, '[|,]'), lambda x: trim(x)), lambda x: x <> ''))), '|'), '') AS tokens,
  split_part(p_name || '|' || p_type, '|', 1) AS first, len(string_split(p_name || '|' || p_type, '|'))::BIGINT AS n FROM part""")
def _(t):
    listed = F.concat(F.regexp_replace("p_name", " ", " , "), F.lit("|"), "p_type", F.lit("|"), "p_name")
    plain = F.concat("p_name", F.lit("|"), "p_type")
    return t("part").select("p_partkey", text.canonical_list(listed).alias("tokens"), text.first_token(plain).alias("first"), text.token_count(plain).cast("long").alias("n"))


# --- islands ------------------------------------------------------------------------------------------------------

VISIT = MergeSpec(("user_id",), "s", "e", order=("event_id",), gap_min=60.0, union_cols=("types",), filled_cols=("kind", "props"), identity="event_id", prefer_filled="kind")
VISITS_SQL = """
ev AS (SELECT event_id, user_id, ts AS s, CASE WHEN event_id % 5 <> 0 THEN ts + to_microseconds(CAST(round(value * 60) AS BIGINT) * 1000000) END AS e0, event_type AS types, CASE WHEN event_type <> 'error' THEN event_type END AS kind, props FROM events),
iv AS (SELECT *, greatest(s, coalesce(e0, s)) AS e FROM ev),
w AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM iv),
isl AS (SELECT *, sum(CASE WHEN b IS NULL OR (epoch_us(s) - epoch_us(b)) > 3600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, event_id) AS island FROM w)"""
MERGED_SQL = f"""SELECT user_id, {STAMP.format('min(s)')} AS s, {STAMP.format('max(e)')} AS e, array_to_string(list_sort(list_distinct(list(types))), '|') AS types,
  arg_min(kind, row(kind IS NULL, s = e, s, event_id)) FILTER (WHERE kind IS NOT NULL) AS kind, arg_min(props, row(kind IS NULL, s = e, s, event_id)) AS props, count(*) AS "N_MERGED",
  string_agg(event_id::VARCHAR, '|' ORDER BY kind IS NULL, s = e, s, event_id) AS "MERGED_IDS", CASE WHEN count(*) > 1 THEN bool_and(s = e) END AS "ZERO_SPAN_ONLY", round((epoch_us(max(e)) - epoch_us(min(s))) / 60e6, 4) AS "SPAN_MIN" FROM isl GROUP BY user_id, island"""


def visits(t: Reader) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    end = F.when(F.col("event_id") % 5 != 0, F.timestamp_micros(F.unix_micros(ts) + F.round(F.col("value") * 60).cast("long") * 1_000_000))
    return t("events").select("event_id", "user_id", ts.alias("s"), end.alias("e"), F.col("event_type").alias("types"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"), "props")


def spelled(df: DataFrame) -> DataFrame:
    return df.select("user_id", stamp(F.col("s")).alias("s"), stamp(F.col("e")).alias("e"), "types", "kind", "props", "N_MERGED", "MERGED_IDS", "ZERO_SPAN_ONLY", F.round("SPAN_MIN", 4).alias("SPAN_MIN"))


EDGES_SQL = f"""WITH {VISITS_SQL}, l AS (SELECT event_id AS row_id, lag(event_id) OVER p AS partner_id, (epoch_us(s) - epoch_us(max(e) OVER (PARTITION BY user_id, island ORDER BY s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))) / 60e6 AS gap
  FROM isl WINDOW p AS (PARTITION BY user_id, island ORDER BY s, event_id)) SELECT row_id, partner_id, round(gap, 4) AS gap_min FROM l WHERE partner_id IS NOT NULL"""


@bind("islands_edges", EDGES_SQL)
def _(t):
    return rounded(islands.edges(visits(t), VISIT, "event_id"))


@bind("islands_merge", f"WITH {VISITS_SQL} {MERGED_SQL}")
def _(t):
    return spelled(islands.merged(visits(t), VISIT))


@bind("month_boundary_remerge", f"WITH {VISITS_SQL} {MERGED_SQL}")
def _(t):
    v, cut = visits(t), F.lit("2024-01-15 12:00:00").cast("timestamp")
    parts = [islands.merged(v.where(half), VISIT, places=True) for half in (F.col("s") < cut, F.col("s").isNull() | (F.col("s") >= cut))]
    return spelled(islands.merge_parts([p.withColumn("event_id", F.substring_index("MERGED_IDS", "|", 1).cast("long")) for p in parts], VISIT))


@bind("islands_gap_sweep", """
WITH g AS (SELECT unnest([15.0, 30.0, 60.0, 120.0]) AS gap_min), iv AS (SELECT gap_min, event_id, user_id, ts AS s, greatest(ts, coalesce(CASE WHEN event_id % 5 <> 0 THEN ts + to_microseconds(CAST(round(value * 60) AS BIGINT) * 1000000) END, ts)) AS e FROM events, g),
w AS (SELECT *, max(e) OVER (PARTITION BY gap_min, user_id ORDER BY s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM iv),
i AS (SELECT *, sum(CASE WHEN b IS NULL OR (epoch_us(s) - epoch_us(b)) / 60e6 > gap_min THEN 1 ELSE 0 END) OVER (PARTITION BY gap_min, user_id ORDER BY s, event_id) AS island FROM w),
p AS (SELECT gap_min, user_id, island, count(*) AS n, (epoch_us(max(e)) - epoch_us(min(s))) / 60e6 AS span FROM i GROUP BY ALL)
SELECT gap_min::DOUBLE AS gap_min, count(*) AS islands, coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS merged_records, max(n) AS largest, round(quantile_cont(span, 0.99), 4) AS span_p99 FROM p GROUP BY ALL""")
def _(t):
    return rounded(islands.sweep(visits(t), VISIT, (15, 30, 60, 120)))


@bind("session_stream_equiv", f"WITH {VISITS_SQL} SELECT user_id, {STAMP.format('min(s)')} AS start, {STAMP.format('max(e)')} AS \"end\", count(*) AS n FROM isl GROUP BY user_id, island")
def _(t):
    out = sessions.island_sessions(visits(t), ("user_id",), "s", "e", 60.0, "2 days")
    return out.select("user_id", stamp(F.col("start")).alias("start"), stamp(F.col("end")).alias("end"), "n")


# --- nearest in time ----------------------------------------------------------------------------------------------

MATCH = MatchSpec(("user_id",), "event_id", "event_id", "ts", "ts", 240.0)
NEAR_SQL = """
p AS (SELECT * FROM events WHERE event_type = 'purchase'), c AS (SELECT * FROM events WHERE event_type = 'click'),
n AS (SELECT p.user_id, p.event_id AS left_id, c.event_id AS right_id, (epoch_us(c.ts) - epoch_us(p.ts)) / 60e6 AS d, row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(c.ts) - epoch_us(p.ts)), c.ts, c.event_id) AS k FROM p JOIN c ON p.user_id = c.user_id),
near AS (SELECT user_id, left_id, right_id, d FROM n WHERE k = 1 AND abs(d) <= 240),
one AS (SELECT *, row_number() OVER (PARTITION BY right_id ORDER BY abs(d), left_id) AS k FROM near), m AS (SELECT user_id, left_id, right_id, d FROM one WHERE k = 1)"""


def purchases(t: Reader) -> DataFrame:
    return t("events").where("event_type = 'purchase'")


def clicks(t: Reader) -> DataFrame:
    return t("events").where("event_type = 'click'")


@bind("nearest_asof", f"WITH {NEAR_SQL} SELECT user_id, left_id, right_id, round(d, 4) AS diff_min FROM near")
def _(t):
    return rounded(nearest.nearest(purchases(t), clicks(t), MATCH).select("user_id", "left_id", "right_id", "diff_min"))


@bind("nearest_one_to_one", f"WITH {NEAR_SQL} SELECT user_id, left_id, right_id, round(d, 4) AS diff_min FROM m")
def _(t):
    return rounded(nearest.match(purchases(t), clicks(t), MATCH).select("user_id", "left_id", "right_id", "diff_min"))


@bind("match_summary", f'WITH {NEAR_SQL} SELECT count(*) AS "MATCHED", (SELECT count(*) FROM p) - count(*) AS "ONLY_LEFT", (SELECT count(*) FROM c) - count(*) AS "ONLY_RIGHT" FROM m')
def _(t):
    a, b = purchases(t), clicks(t)
    return nearest.match_summary(a, b, nearest.match(a, b, MATCH))


@bind("offset_histogram", f"WITH {NEAR_SQL} SELECT round(d)::DOUBLE AS \"offset\", count(*) AS n FROM m GROUP BY ALL ORDER BY n DESC, \"offset\" LIMIT 10")
def _(t):
    return nearest.offset_histogram(nearest.match(purchases(t), clicks(t), MATCH), top=10)


@bind("modal_offset", f"WITH {NEAR_SQL}, o AS (SELECT user_id % 10 AS g, round(d / 30)::DOUBLE AS o, count(*) AS n FROM m GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, o) AS k, sum(n) OVER (PARTITION BY g) AS total FROM o) SELECT g, o AS mode, n, total::BIGINT AS total, round(100.0 * n / total, 4) AS share FROM r WHERE k = 1")
def _(t):
    pairs = nearest.match(purchases(t), clicks(t), MATCH).withColumns({"g": F.col("user_id") % 10, "half_hours": F.col("diff_min") / 30})
    return nearest.modal_offset(pairs, ("g",), "half_hours")


@bind("cascade_match", """
WITH a AS (SELECT event_id, user_id, user_id % 20 AS g, ts FROM events WHERE event_type = 'purchase'), b AS (SELECT event_id, user_id, user_id % 20 AS g, ts FROM events WHERE event_type = 'signup'),
n1 AS (SELECT a.event_id AS l, b.event_id AS r, (epoch_us(b.ts) - epoch_us(a.ts)) / 60e6 AS d, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(epoch_us(b.ts) - epoch_us(a.ts)), b.ts, b.event_id) AS k FROM a JOIN b ON a.user_id = b.user_id),
m1 AS (SELECT l, r, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY abs(d), l) AS j FROM n1 WHERE k = 1 AND abs(d) <= 120) WHERE j = 1),
a2 AS (SELECT * FROM a WHERE event_id NOT IN (SELECT l FROM m1)), b2 AS (SELECT * FROM b WHERE event_id NOT IN (SELECT r FROM m1)),
n2 AS (SELECT a2.event_id AS l, b2.event_id AS r, (epoch_us(b2.ts) - epoch_us(a2.ts)) / 60e6 AS d, row_number() OVER (PARTITION BY a2.event_id ORDER BY abs(epoch_us(b2.ts) - epoch_us(a2.ts)), b2.ts, b2.event_id) AS k FROM a2 JOIN b2 ON a2.g = b2.g),
m2 AS (SELECT l, r, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY abs(d), l) AS j FROM n2 WHERE k = 1 AND abs(d) <= 60) WHERE j = 1)
SELECT 'user' AS pass, l AS left_id, r AS right_id, round(d, 4) AS diff_min FROM m1 UNION ALL SELECT 'group', l, r, round(d, 4) FROM m2""")
def _(t):
    ev = t("events").withColumn("g", F.col("user_id") % 20)
    out = nearest.cascade(ev.where("event_type = 'purchase'"), ev.where("event_type = 'signup'"), MATCH, [("user", ("user_id",), 120.0), ("group", ("g",), 60.0)])
    return rounded(out)


PAIRS_SQL = """
ev AS (SELECT event_id, user_id, ts AS s, CASE WHEN event_id % 3 = 0 THEN ts ELSE ts + to_microseconds(CAST(round(value * 60) AS BIGINT) * 1000000) END AS e, CASE WHEN event_id % 4 <> 0 THEN event_type END AS reg FROM events),
f AS (SELECT *, s = e AS plan FROM ev),
q AS (SELECT p.event_id AS l, m.event_id AS r, (epoch_us(m.s) - epoch_us(p.s)) / 60e6 AS d, row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(m.s) - epoch_us(p.s)), m.s, m.event_id) AS k FROM f p JOIN f m ON p.user_id = m.user_id AND p.plan AND NOT m.plan),
pm AS (SELECT l, r, abs(d) AS gap, 'plan + movement' AS kind FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY abs(d), l) AS j FROM q WHERE k = 1 AND abs(d) <= 180) WHERE j = 1),
lg AS (SELECT event_id AS l, lag(event_id) OVER w AS r, (epoch_us(s) - epoch_us(lag(s) OVER w)) / 60e6 AS gap, reg, lag(reg) OVER w AS reg2, plan FROM f WINDOW w AS (PARTITION BY user_id, plan ORDER BY s, event_id)),
rp AS (SELECT l, r, gap, CASE WHEN plan THEN 'repeated plan' ELSE 'repeated movement' END AS kind FROM lg WHERE gap <= 60 AND (reg IS NULL OR reg2 IS NULL OR reg = reg2)),
pairs AS (SELECT * FROM pm UNION ALL SELECT * FROM rp)"""


def records(t: Reader) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    end = F.when(F.col("event_id") % 3 == 0, ts).otherwise(F.timestamp_micros(F.unix_micros(ts) + F.round(F.col("value") * 60).cast("long") * 1_000_000))
    return t("events").select("event_id", "user_id", ts.alias("s"), end.alias("e"), F.when(F.col("event_id") % 4 != 0, F.col("event_type")).alias("reg"), F.col("event_type").alias("types"), "props")


def record_pairs(t: Reader) -> DataFrame:
    return nearpairs.near_pairs(records(t), ("user_id",), "event_id", "s", "e", "reg", near_min=60.0)


@bind("near_pairs", f"WITH {PAIRS_SQL} SELECT l AS row_id, r AS partner_id, round(gap, 4) AS gap_min, kind FROM pairs")
def _(t):
    return rounded(record_pairs(t))


@bind("near_listing", f"""WITH {PAIRS_SQL} SELECT l AS pair, 'repeat' AS role, l AS id, kind, round(gap, 4) AS gap_min, types FROM pairs JOIN (SELECT event_id, event_type AS types FROM events) ON l = event_id
UNION ALL SELECT l, 'original', r, kind, round(gap, 4), types FROM pairs JOIN (SELECT event_id, event_type AS types FROM events) ON r = event_id""")
def _(t):
    return rounded(nearpairs.listing(records(t), record_pairs(t), "event_id", ("types",)))


@bind("components_collapse", f"""WITH RECURSIVE {PAIRS_SQL}, ed AS (SELECT l AS a, r AS b FROM pairs UNION SELECT r, l FROM pairs),
reach AS (SELECT a AS node, a AS seen FROM ed UNION SELECT reach.node, ed.b FROM reach JOIN ed ON reach.seen = ed.a), comp AS (SELECT node, min(seen) AS g FROM reach GROUP BY node),
x AS (SELECT f.*, coalesce(g, event_id) AS g FROM (SELECT f.*, ev2.event_type AS types FROM f JOIN events ev2 USING (event_id)) f LEFT JOIN comp ON node = event_id)
SELECT user_id, {STAMP.format('min(s)')} AS s, {STAMP.format('max(e)')} AS e, array_to_string(list_sort(list_distinct(list(types))), '|') AS types, count(*) AS "N_MERGED",
  string_agg(event_id::VARCHAR, '|' ORDER BY reg IS NULL, s = e, s, event_id) AS "MERGED_IDS" FROM x GROUP BY user_id, g""")
def _(t):
    spec = MergeSpec(("user_id",), "s", "e", order=("event_id",), union_cols=("types",), filled_cols=("reg", "props"), identity="event_id", prefer_filled="reg")
    out = nearpairs.merge_near(records(t), record_pairs(t), spec, "event_id")
    return out.select("user_id", stamp(F.col("s")).alias("s"), stamp(F.col("e")).alias("e"), "types", "N_MERGED", "MERGED_IDS")


# --- reconciliation -----------------------------------------------------------------------------------------------

VERSIONS_SQL = """
lv AS (SELECT o_orderkey, o_custkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority, o_totalprice, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderkey END AS k FROM (SELECT o_custkey, o_orderstatus, o_orderpriority, o_totalprice, CASE WHEN o_orderkey % 13 = 0 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey FROM orders)),
rv AS (SELECT o_orderkey, o_custkey + CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END AS o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, nullif(o_orderpriority, '1-URGENT') AS priority,
  o_totalprice + CASE WHEN o_orderkey % 8 = 0 THEN 0.5 ELSE 0 END AS o_totalprice, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderkey END AS k FROM (SELECT o_custkey, o_orderstatus, o_orderpriority, o_totalprice, CASE WHEN o_orderkey % 17 = 0 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey FROM orders))"""
FIELDS = ("o_custkey", "o_orderstatus", "priority")


def versions(t: Reader) -> tuple[DataFrame, DataFrame]:
    """Two versions of all orders: some keys are another's on either side, and some values differ."""
    k = F.col("o_orderkey")
    other = lambda n: t("orders").withColumn("o_orderkey", F.when(k % n == 0, -k).otherwise(k))
    key = F.when(k % 50 != 0, k).alias("k")
    left = other(13).select("o_orderkey", "o_custkey", "o_orderstatus", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"), "o_totalprice", key)
    right = other(17).select("o_orderkey", (F.col("o_custkey") + F.when(k % 9 == 0, 1).otherwise(0)).alias("o_custkey"), F.when(k % 10 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("priority"), (F.col("o_totalprice") + F.when(k % 8 == 0, 0.5).otherwise(0.0)).alias("o_totalprice"), key)
    return left, right


@bind("keyed_diff_summary", f"""WITH {VERSIONS_SQL}, a AS (SELECT DISTINCT o_orderstatus, k FROM lv), b AS (SELECT DISTINCT o_orderstatus, k FROM rv), j AS (SELECT coalesce(a.o_orderstatus, b.o_orderstatus) AS st, a.o_orderstatus AS l, b.o_orderstatus AS r FROM a FULL JOIN b ON a.o_orderstatus = b.o_orderstatus AND a.k IS NOT DISTINCT FROM b.k)
SELECT st AS o_orderstatus, count(l) AS n_left, count(r) AS n_right, count(*) FILTER (WHERE l IS NOT NULL AND r IS NOT NULL) AS n_both, count(*) FILTER (WHERE r IS NULL) AS only_left, count(*) FILTER (WHERE l IS NULL) AS only_right FROM j GROUP BY ALL""")
def _(t):
    return reconcile.keyed_diff(*versions(t), ("o_orderstatus", "k"), ("o_orderstatus",))


@bind("anti_left", f"WITH {VERSIONS_SQL} SELECT o_orderkey, o_custkey FROM lv WHERE NOT EXISTS (SELECT 1 FROM rv WHERE rv.k IS NOT DISTINCT FROM lv.k AND rv.priority IS NOT DISTINCT FROM lv.priority)")
def _(t):
    l, r = versions(t)
    return reconcile.only_left(l, r, ("k", "priority")).select("o_orderkey", "o_custkey")


@bind("anti_right", f"WITH {VERSIONS_SQL} SELECT o_orderkey, o_custkey FROM rv WHERE NOT EXISTS (SELECT 1 FROM lv WHERE rv.k IS NOT DISTINCT FROM lv.k AND rv.priority IS NOT DISTINCT FROM lv.priority)")
def _(t):
    l, r = versions(t)
    return reconcile.only_left(r, l, ("k", "priority")).select("o_orderkey", "o_custkey")


@bind("semi", f"WITH {VERSIONS_SQL} SELECT o_orderkey, o_custkey FROM lv WHERE EXISTS (SELECT 1 FROM rv WHERE rv.k IS NOT DISTINCT FROM lv.k AND rv.priority IS NOT DISTINCT FROM lv.priority)")
def _(t):
    l, r = versions(t)
    return reconcile.shared(l, r, ("k", "priority")).select("o_orderkey", "o_custkey")


def _field_sql(differs: str) -> str:
    one = f"SELECT '{{f}}' AS field, count(*) AS n, round(100.0 * count(*) FILTER (WHERE {differs}) / count(*), 4) AS pct_different, round(100.0 * count(*) FILTER (WHERE l.{{f}} IS NOT NULL AND r.{{f}} IS NULL) / count(*), 4) AS pct_only_left, round(100.0 * count(*) FILTER (WHERE r.{{f}} IS NOT NULL AND l.{{f}} IS NULL) / count(*), 4) AS pct_only_right FROM lv l JOIN rv r USING (o_orderkey)"
    return f"WITH {VERSIONS_SQL} " + " UNION ALL ".join(one.format(f=f) for f in FIELDS)


@bind("field_disagreement", _field_sql("l.{f} IS DISTINCT FROM r.{f}"))
def _(t):
    return reconcile.field_disagreement(reconcile.paired(*versions(t), ("o_orderkey",), FIELDS, ("o_custkey",)), FIELDS)


@bind("field_disagreement_values", _field_sql("l.{f} <> r.{f}"))
def _(t):
    return reconcile.field_disagreement(reconcile.paired(*versions(t), ("o_orderkey",), FIELDS, ("o_custkey",)), FIELDS, null_is_difference=False)


@bind("value_pair_table", f"WITH {VERSIONS_SQL} SELECT l.priority AS left_value, r.priority AS right_value, count(*) AS n FROM lv l JOIN rv r USING (o_orderkey) GROUP BY ALL")
def _(t):
    return reconcile.value_pairs(reconcile.paired(*versions(t), ("o_orderkey",), FIELDS, ("o_custkey",)), "priority")


@bind("missing_values", """WITH a AS (SELECT l_partkey AS v, count(*) AS n FROM lineitem GROUP BY ALL), b AS (SELECT CASE WHEN p_partkey % 7 = 0 THEN -p_partkey ELSE p_partkey END AS v, count(*) AS n FROM part GROUP BY ALL)
SELECT v AS value, 'left' AS side, n FROM a WHERE v NOT IN (SELECT v FROM b) UNION ALL SELECT v, 'right', n FROM b WHERE v NOT IN (SELECT v FROM a)""")
def _(t):
    p = F.col("p_partkey")
    a, b = t("lineitem").select(F.col("l_partkey").alias("v")), t("part").select(F.when(p % 7 == 0, -p).otherwise(p).alias("v"))
    return reconcile.missing_values(a, b, "v")


@bind("overlap_share", f"WITH {VERSIONS_SQL}, a AS (SELECT DISTINCT o_custkey FROM lv), b AS (SELECT DISTINCT o_custkey FROM rv) SELECT (SELECT count(*) FROM a) AS n_left, (SELECT count(*) FROM b) AS n_right, count(*) AS shared, round(100.0 * count(*) / (SELECT count(*) FROM a), 4) AS pct_left FROM a JOIN b USING (o_custkey)")
def _(t):
    return reconcile.overlap_share(*versions(t), "o_custkey")


@bind("key_shape", "SELECT min(length(p_brand)) AS min_length, max(length(p_brand)) AS max_length, bool_and(regexp_matches(p_brand, '^Brand#[0-9]+$')) AS all_match, count(*) - count(p_brand) AS n_null FROM part")
def _(t):
    return reconcile.key_shape(t("part"), "p_brand", "^Brand#[0-9]+$")


@bind("gap_profile", "WITH e AS (SELECT event_type, ts AS s, CASE WHEN event_id % 3 = 0 THEN ts ELSE ts + INTERVAL 1 MINUTE END AS e FROM events) SELECT event_type, count(*) AS n, count(*) FILTER (WHERE s = e) AS n_no_span, round(100.0 * count(*) FILTER (WHERE s = e) / count(*), 4) AS pct_no_span FROM e GROUP BY ALL")
def _(t):
    ts = F.col("ts").cast("timestamp")
    df = t("events").select("event_type", ts.alias("s"), F.when(F.col("event_id") % 3 == 0, ts).otherwise(time.shifted(ts, 1)).alias("e"))
    return reconcile.gap_profile(df, "s", "e", (F.col("event_type"),))


@bind("validation_verdict", f"""WITH {VERSIONS_SQL}, a AS (SELECT priority, o_orderstatus, sum(o_totalprice::DECIMAL(18, 2)) AS price, count(*) AS n FROM lv GROUP BY ALL),
b AS (SELECT l.priority, l.o_orderstatus, sum(r.o_totalprice::DECIMAL(18, 2)) AS price, count(*) AS n FROM lv l JOIN rv r USING (o_orderkey) GROUP BY ALL),
j AS (SELECT a.price AS pg, b.price AS po, a.n AS ng, b.n AS no FROM a JOIN b ON a.priority IS NOT DISTINCT FROM b.priority AND a.o_orderstatus IS NOT DISTINCT FROM b.o_orderstatus),
f AS (SELECT 'price' AS field, count(*) AS n, count(*) FILTER (WHERE abs(pg - po) <= 1e-6) AS equal, max(abs(pg - po))::DOUBLE AS max_diff, sum(pg)::DOUBLE AS sum_golden, sum(po)::DOUBLE AS sum_ours FROM j
  UNION ALL SELECT 'n', count(*), count(*) FILTER (WHERE ng = no), max(abs(ng - no))::DOUBLE, sum(ng)::DOUBLE, sum(no)::DOUBLE FROM j)
SELECT field, n, equal, n - equal AS different, round(max_diff, 2) AS max_diff, round(sum_golden, 2) AS sum_golden, round(sum_ours, 2) AS sum_ours,
  CASE WHEN n = equal THEN 'PASS' WHEN abs(100 * (sum_ours - sum_golden) / sum_golden) <= 0.05 AND 100.0 * equal / n >= 99.9 THEN 'WITHIN_TOLERANCE' ELSE 'FAIL' END AS verdict FROM f""")
def _(t):
    l, r = versions(t)
    by = lambda df: df.groupBy("priority", "o_orderstatus").agg(F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("price"), F.count("*").cast("double").alias("n"))
    both = l.join(r.select("o_orderkey", F.col("o_totalprice").alias("price")), "o_orderkey")
    out = reconcile.validate(by(l.withColumn("price", F.col("o_totalprice"))), by(both), ("priority", "o_orderstatus"), ("price", "n"))
    return out.select("field", "n", "equal", "different", *[F.round(c, 2).alias(c) for c in ("max_diff", "sum_golden", "sum_ours")], "verdict")


@bind("worst_offenders", f"""WITH {VERSIONS_SQL} SELECT o_custkey, golden, ours, round(abs(golden - ours), 4) AS difference FROM (SELECT o_custkey, sum(o_totalprice::DECIMAL(18, 2))::DOUBLE AS golden FROM lv GROUP BY ALL) JOIN (SELECT o_custkey, sum(o_totalprice::DECIMAL(18, 2))::DOUBLE AS ours FROM rv GROUP BY ALL) USING (o_custkey) ORDER BY abs(golden - ours) DESC, o_custkey LIMIT 10""")
def _(t):
    by = lambda df: df.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("price"))
    l, r = versions(t)
    return reconcile.worst_offenders(by(l), by(r), ("o_custkey",), "price").withColumn("difference", F.round("difference", 4))


@bind("time_shift_by_month", """WITH p AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderdate AS l, o_orderdate + to_minutes(CAST(CASE WHEN month(o_orderdate) BETWEEN 4 AND 9 THEN 60 ELSE 0 END + CASE WHEN o_orderkey % 10 = 0 THEN 3 ELSE 0 END AS BIGINT)) AS r FROM orders),
d AS (SELECT month, (epoch_us(r) - epoch_us(l)) / 60e6 AS d FROM p), c AS (SELECT month, round(d)::DOUBLE AS o, count(*) AS k FROM d GROUP BY ALL), m AS (SELECT month, o AS mode, k AS n_mode FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY k DESC, o) AS j FROM c) WHERE j = 1),
x AS (SELECT month, count(*) AS n, median(d)::DOUBLE AS median FROM d GROUP BY ALL) SELECT month, n, median, mode, n_mode, round(100.0 * n_mode / n, 4) AS pct_mode, mode - lag(mode) OVER (ORDER BY month) AS change, coalesce(abs(mode - lag(mode) OVER (ORDER BY month)) >= 60, false) AS is_step FROM x JOIN m USING (month)""")
def _(t):
    l = F.col("o_orderdate").cast("timestamp")
    add = F.when(F.month(l).between(4, 9), 60).otherwise(0) + F.when(F.col("o_orderkey") % 10 == 0, 3).otherwise(0)
    pairs = t("orders").select(F.date_format(l, "yyyy-MM").alias("month"), l.alias("l"), F.timestamp_micros(F.unix_micros(l) + add.cast("long") * 60_000_000).alias("r"))
    return reconcile.step_test(reconcile.time_shift(pairs, "l", "r", ("month",)))


@bind("window_shape", f"WITH {VISITS_SQL}, d AS (SELECT types, (epoch_us(e) - epoch_us(s)) / 60e6 AS d FROM iv) SELECT types, count(*) AS n, count(*) FILTER (WHERE d = 0) AS n_zero, round(100.0 * count(*) FILTER (WHERE d = 0) / count(*), 4) AS pct_zero, round(quantile_cont(d, 0.25), 4) AS p25, round(quantile_cont(d, 0.5), 4) AS p50, round(quantile_cont(d, 0.75), 4) AS p75, round(quantile_cont(d, 0.99), 4) AS p99 FROM d GROUP BY ALL")
def _(t):
    return rounded(reconcile.window_shape(visits(t).withColumn("e", F.coalesce("e", "s")), "s", "e", ("types",)))


# --- coverage -----------------------------------------------------------------------------------------------------


@bind("day_counts", "SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL")
def _(t):
    return coverage.day_counts(t("events"), "ts", ("event_type",)).withColumn("day", F.col("day").cast("string"))


@bind("month_coverage", """WITH d AS (SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY ALL) SELECT strftime(day, '%Y-%m') AS month, sum(n)::BIGINT AS n, count(*) AS days, max(day(last_day(day)))::BIGINT AS possible,
  count(*) >= max(day(last_day(day))) - 1 AS enough, CASE WHEN count(*) >= 28 THEN 'complete' WHEN count(*) >= 20 THEN 'partial' ELSE 'truncated' END AS status FROM d GROUP BY ALL""")
def _(t):
    return coverage.month_coverage(t("orders"), "o_orderdate")


@bind("missing_days", "SELECT strftime(d, '%Y-%m-%d') AS day FROM generate_series(DATE '1990-01-01', DATE '2005-12-31', INTERVAL 1 DAY) g(d) WHERE d::DATE NOT IN (SELECT o_orderdate::DATE FROM orders)")
def _(t):
    return coverage.missing_days(t("orders"), "o_orderdate", "1990-01-01", "2005-12-31").select(F.col("day").cast("string").alias("day"))


@bind("year_coverage", """WITH h AS (SELECT year(o_orderdate) AS year, count(*) AS n, count(DISTINCT o_orderdate::DATE) AS days FROM orders GROUP BY ALL), s AS (SELECT unnest([1994, 1995, 1996, 1999, 2001, 2002]) AS year),
p AS (SELECT s.year, coalesce(n, 0) AS n, coalesce(days, 0) AS days, greatest(0, date_diff('day', make_date(s.year, 1, 1), least(make_date(s.year, 12, 31), DATE '2001-07-31')) + 1)::BIGINT AS possible FROM s LEFT JOIN h USING (year))
SELECT year, n, days, possible, greatest(possible - days, 0) AS missing, possible > 0 AND greatest(possible - days, 0) <= 1 AS complete FROM p""")
def _(t):
    return coverage.year_coverage(t("orders"), "o_orderdate", (1994, 1995, 1996, 1999, 2001, 2002), "2001-07-31")


@bind("edge_days", """WITH d AS (SELECT year(o_orderdate)::INTEGER AS year, o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY ALL), y AS (SELECT year, min(day) AS f, max(day) AS l, avg(n) AS mean FROM d GROUP BY ALL)
SELECT d.year, edge, strftime(day, '%Y-%m-%d') AS day, n, round(mean, 6) AS mean, n < mean * 0.5 AS partial FROM d JOIN y USING (year), (VALUES ('first'), ('last')) e(edge) WHERE (edge = 'first' AND day = f) OR (edge = 'last' AND day = l)""")
def _(t):
    return coverage.edge_days(t("orders"), "o_orderdate").withColumns({"day": F.col("day").cast("string"), "mean": F.round("mean", 6)})


@bind("boundary_rows", "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-14 06:00:00' AND ts < TIMESTAMP '2024-01-15 18:00:00'")
def _(t):
    return coverage.boundary_rows(t("events"), "ts", "2024-01-15 00:00:00", 18).select("event_id", "event_type")


@bind("partial_years", "SELECT substr(o_orderdate::VARCHAR, 1, 4) AS year, max(substr(o_orderdate::VARCHAR, 1, 10)) AS last_day FROM orders GROUP BY 1 HAVING max(substr(o_orderdate::VARCHAR, 1, 10)) < substr(o_orderdate::VARCHAR, 1, 4) || '-12-31'")
def _(t):
    df = t("orders").withColumn("d", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return coverage.partial_years(df, "d")


@bind("year_under_definitions", """WITH u AS (SELECT 'ordered' AS definition, o_orderdate AS t FROM orders JOIN lineitem ON l_orderkey = o_orderkey UNION ALL SELECT 'shipped', l_shipdate FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
SELECT definition, clock, year(t + to_hours(CAST(h AS BIGINT))) AS year, count(*) AS n FROM u, (VALUES ('utc', 0), ('local', -3)) c(clock, h) GROUP BY ALL""")
def _(t):
    df = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderdate").alias("o"), F.col("l_shipdate").alias("s"))
    return coverage.years_by_definition(df, {"ordered": "o", "shipped": "s"}, {"utc": 0, "local": -3}).withColumn("year", F.col("year").cast("long"))


CLOCK_ONE = "SELECT '{n}' AS stamp, count(*) AS n, count(*) - count({c}) AS n_null, count(*) FILTER (WHERE hour({c}) = 0 AND minute({c}) = 0 AND floor(second({c})) = 0) AS n_midnight, count(*) FILTER (WHERE minute({c}) = 0 AND second({c}) = 0) AS n_hour FROM e"


@bind("midnight_share", "WITH e AS (SELECT CASE WHEN event_id % 6 <> 0 THEN date_trunc('hour', ts) END AS a, CASE WHEN event_id % 4 = 0 THEN date_trunc('day', ts) ELSE ts END AS b FROM events), u AS (" + CLOCK_ONE.format(n="a", c="a") + " UNION ALL " + CLOCK_ONE.format(n="b", c="b") + ") SELECT *, round(100.0 * n_midnight / (n - n_null), 4) AS pct_midnight, round(100.0 * n_hour / (n - n_null), 4) AS pct_hour FROM u")
def _(t):
    df = t("events").select(F.when(F.col("event_id") % 6 != 0, F.date_trunc("hour", F.col("ts").cast("timestamp"))).alias("a"), F.when(F.col("event_id") % 4 == 0, F.date_trunc("day", F.col("ts").cast("timestamp"))).otherwise(F.col("ts").cast("timestamp")).alias("b"))
    return coverage.clock_shares(df, ("a", "b"))


@bind("stamp_agreement", f"WITH {VISITS_SQL}, d AS (SELECT types, abs(epoch_us(e0) - epoch_us(s)) / 60e6 AS d FROM iv WHERE e0 IS NOT NULL) SELECT types, count(*) AS n, count(*) FILTER (WHERE d = 0) AS n_equal, round(median(d) FILTER (WHERE d > 0), 4) AS median_diff, round(max(d) FILTER (WHERE d > 0), 4) AS max_diff, round(100.0 * count(*) FILTER (WHERE d = 0) / count(*), 4) AS pct_equal FROM d GROUP BY ALL")
def _(t):
    return rounded(coverage.stamp_agreement(visits(t), "s", "e", ("types",)))


@bind("estimate_check", """WITH p AS (SELECT l_returnflag, o_orderdate AS est, l_shipdate + INTERVAL 1 HOUR AS act, CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE 7 END AS h FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
d AS (SELECT l_returnflag, h <> 0 AS timed, (epoch_us(est + to_hours(CAST(h AS BIGINT))) - epoch_us(act)) / 60e6 AS d FROM p)
SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE NOT timed) AS n_timeless, round(median(d) FILTER (WHERE timed), 4) AS median_diff, count(*) FILTER (WHERE timed AND d BETWEEN -100000 AND 100000) AS n_plausible, count(*) FILTER (WHERE timed AND d < 0) AS n_negative,
  round(100.0 * count(*) FILTER (WHERE NOT timed) / count(*), 4) AS pct_timeless, round(100.0 * count(*) FILTER (WHERE timed AND d BETWEEN -100000 AND 100000) / count(*) FILTER (WHERE timed), 4) AS pct_plausible, round(100.0 * count(*) FILTER (WHERE timed AND d < 0) / count(*) FILTER (WHERE timed), 4) AS pct_negative FROM d GROUP BY ALL""")
def _(t):
    both = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    hours = F.when(F.col("l_linenumber") % 3 == 0, 0).otherwise(7)
    df = both.select("l_returnflag", F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + hours.cast("long") * 3_600_000_000).alias("est"), time.shifted(F.col("l_shipdate"), 60).alias("act"))
    return rounded(coverage.estimate_check(df, "est", "act", -100000, 100000, ("l_returnflag",)))


@bind("source_overlap", """WITH a AS (SELECT DISTINCT n_regionkey AS g, n_name AS k FROM customer JOIN nation ON c_nationkey = n_nationkey), b AS (SELECT DISTINCT n_regionkey AS g, lower(n_name) AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey),
j AS (SELECT coalesce(a.g, b.g) AS g, a.k AS l, b.k AS r FROM a FULL JOIN b ON a.g = b.g AND upper(a.k) = upper(b.k)) SELECT g, count(l) AS n_left, count(r) AS n_right, count(*) FILTER (WHERE l IS NOT NULL AND r IS NOT NULL) AS shared, count(*) FILTER (WHERE r IS NULL) AS only_left, count(*) FILTER (WHERE l IS NULL) AS only_right FROM j GROUP BY ALL""")
def _(t):
    n = t("nation")
    a = t("customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_regionkey").alias("g"), F.col("n_name").alias("k"))
    b = t("supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_regionkey").alias("g"), F.lower("n_name").alias("k"))
    return coverage.source_overlap(a, b, ("g",), "k")


@bind("populated_fields", "WITH e AS (SELECT CASE WHEN event_id % 3 = 0 THEN ' ' ELSE event_type END AS a, CASE WHEN event_id % 4 <> 0 THEN props END AS b FROM events) SELECT 'a' AS field, count(*) AS n, count(nullif(trim(a), '')) AS filled, round(100.0 * count(nullif(trim(a), '')) / count(*), 4) AS pct_filled FROM e UNION ALL SELECT 'b', count(*), count(nullif(trim(b), '')), round(100.0 * count(nullif(trim(b), '')) / count(*), 4) FROM e")
def _(t):
    df = t("events").select(F.when(F.col("event_id") % 3 == 0, " ").otherwise(F.col("event_type")).alias("a"), F.when(F.col("event_id") % 4 != 0, F.col("props")).alias("b"))
    return coverage.populated(df, ("a", "b"))


@bind("share_of_total", "WITH c AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL) SELECT *, round(100.0 * n / sum(n) OVER (PARTITION BY l_returnflag), 4) AS pct FROM c")
def _(t):
    return coverage.share_of_total(t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n")), "n", ("l_returnflag",))


# --- reshape ------------------------------------------------------------------------------------------------------

RING_WIDE = "SELECT l_suppkey, nullif(l_linestatus, 'O') AS st, " + ", ".join(f"max(CASE WHEN l_returnflag = '{r}' THEN {v} END) AS \"{r}_{n}\"" for r in "ANR" for n, v in (("q", "q"), ("p", "p"))) + " FROM (SELECT l_suppkey, nullif(l_linestatus, 'O') AS l_linestatus, l_returnflag, sum(l_quantity)::BIGINT AS q, count(*) AS p FROM lineitem GROUP BY ALL) GROUP BY ALL"


def rings(t: Reader) -> DataFrame:
    df = t("lineitem").groupBy("l_suppkey", F.nullif(F.col("l_linestatus"), F.lit("O")).alias("st"), "l_returnflag").agg(F.sum("l_quantity").cast("long").alias("q"), F.count("*").alias("p"))
    return reshape.widened(df, ("l_suppkey", "st"), "l_returnflag", ("A", "N", "R"), ("q", "p"))


@bind("ring_pivot", RING_WIDE)
def _(t):
    return rings(t)


@bind("ring_unpivot", f"WITH w AS ({RING_WIDE}) SELECT l_suppkey, st, 'A' AS ring, \"A_q\" AS q, \"A_p\" AS p FROM w WHERE \"A_q\" IS NOT NULL OR \"A_p\" IS NOT NULL UNION ALL SELECT l_suppkey, st, 'N', \"N_q\", \"N_p\" FROM w WHERE \"N_q\" IS NOT NULL OR \"N_p\" IS NOT NULL UNION ALL SELECT l_suppkey, st, 'R', \"R_q\", \"R_p\" FROM w WHERE \"R_q\" IS NOT NULL OR \"R_p\" IS NOT NULL")
def _(t):
    return reshape.lengthened(rings(t), ("l_suppkey", "st"), "ring", ("A", "N", "R"), ("q", "p"))


@bind("ends_to_movements", """WITH l AS (SELECT s_nationkey AS dep, c_nationkey AS arr FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey JOIN customer ON c_custkey = o_custkey), m AS (SELECT dep AS place, 'DEP' AS phase FROM l UNION ALL SELECT arr, 'ARR' FROM l)
SELECT place, count(*) FILTER (WHERE phase = 'DEP') AS "DEP", count(*) FILTER (WHERE phase = 'ARR') AS "ARR" FROM m GROUP BY ALL""")
def _(t):
    l = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("supplier"), F.col("s_suppkey") == F.col("l_suppkey")).join(t("customer"), F.col("c_custkey") == F.col("o_custkey"))
    return reshape.counts_wide(reshape.ends_to_movements(l, "s_nationkey", "c_nationkey"), ("place",), "phase", ("DEP", "ARR"))


@bind("nested_payload", """WITH c AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL), d AS (SELECT event_type, '{' || string_agg('"' || day || '":{"n":' || n || '}', ',' ORDER BY day) || '}' AS j FROM c GROUP BY ALL)
SELECT '{' || string_agg('"' || event_type || '":' || j, ',' ORDER BY event_type) || '}' AS json FROM d""")
def _(t):
    from aeroperf.sinks.files import payload_json

    c = t("events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    return payload_json(c, ("event_type", "day"), F.struct("n"))


# --- scalar functions ---------------------------------------------------------------------------------------------


@bind("scalar_text", r"""SELECT page_id, nullif(regexp_replace(CASE WHEN page_id % 5 = 0 THEN E' \t ' ELSE E'\t' || url || ' ' END, '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g'), '') AS clean, upper(trim(url)) AS key,
  CASE page_id % 3 WHEN 0 THEN 'ARR' WHEN 1 THEN 'DEP' END AS phase, CASE WHEN page_id % 4 IN (0, 1) THEN 'TRUE' WHEN page_id % 4 = 2 THEN 'FALSE' ELSE 'MAYBE' END AS truth FROM pages""")
def _(t):
    p = F.col("page_id")
    raw = F.when(p % 5 == 0, F.lit(" \t ")).otherwise(F.concat(F.lit("\t"), "url", F.lit(" ")))
    spoken = F.when(p % 4 == 0, "t").when(p % 4 == 1, " Sim ").when(p % 4 == 2, "0").otherwise("maybe")
    return t("pages").select("page_id", text.clean(raw).alias("clean"), text.key_text(F.col("url")).alias("key"), text.recode(F.when(p % 3 == 0, "Arr").when(p % 3 == 1, "Dep").otherwise("xxx"), {"Arr": "ARR", "Dep": "DEP"}).alias("phase"), text.truth(spoken).alias("truth"))


@bind("scalar_time", f"""WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN TIMESTAMP '1970-01-01 00:00:00' WHEN event_id % 7 = 1 THEN NULL ELSE date_trunc('second', ts) END AS t FROM events)
SELECT event_id, strftime(CASE WHEN t >= TIMESTAMP '1980-01-01' THEN t END, '%Y-%m-%d %H:%M:%S') AS parsed, strftime(CASE WHEN t >= TIMESTAMP '1980-01-01' THEN t - INTERVAL 3 HOUR END, '%Y-%m-%d %H:%M:%S') AS local, strftime(t, '%Y-%m') AS month, day(last_day(t))::BIGINT AS month_days, hour(t) = 0 AND minute(t) = 0 AND second(t) = 0 AS midnight FROM e""")
def _(t):
    e, ts = F.col("event_id"), F.date_trunc("second", F.col("ts").cast("timestamp"))
    raw = F.when(e % 7 == 0, "1970-01-01 00:00:00").when(e % 7 == 1, " ").when(e % 7 == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).when(e % 7 == 3, F.date_format(ts, "dd/MM/yyyy HH:mm:ss")).when(e % 7 == 4, F.date_format(ts, "dd-MM-yyyy HH:mm:ss")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.S"))
    p = time.parse_stamp(raw)
    say = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return t("events").select("event_id", say(time.no_sentinel(p)).alias("parsed"), say(time.shifted(time.no_sentinel(p), -180)).alias("local"), time.month_text(p).alias("month"), time.days_in_month(p).cast("long").alias("month_days"), time.is_midnight(p).alias("midnight"))


@bind("scalar_duration", """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE round(CASE WHEN event_id % 3 = 1 THEN -1 ELSE 1 END * ((event_id % 5) * 60 + event_id % 60 + (event_id % 59) / 60.0), 6)::DOUBLE END AS minutes,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'S' || lpad(((event_id % 800) % 360)::VARCHAR, 3, '0') END AS sector, round(least(greatest(value, 5), 50), 4) AS clamped, CASE event_type WHEN 'view' THEN 1.5 WHEN 'click' THEN 2.5 END::DOUBLE AS looked, round(100 * value / nullif(event_id % 2, 0), 2) AS share FROM events""")
def _(t):
    e = F.col("event_id")
    said = F.format_string("%s%d:%02d:%02d", F.when(e % 3 == 1, "-").otherwise(""), e % 5, e % 60, e % 59)
    duration = time.duration_minutes(F.when(e % 3 == 2, F.format_string("%02d:%02d", e % 60, e % 59)).otherwise(said))
    sector = numbers.sector_group(F.when(e % 4 == 0, F.when(e % 8 == 0, " ").otherwise("x")).otherwise(F.format_string("%d.7", e % 800)))
    return t("events").select("event_id", F.round(duration, 6).alias("minutes"), sector.alias("sector"), F.round(numbers.clamp(F.col("value"), 5.0, 50.0), 4).alias("clamped"), numbers.lookup(F.col("event_type"), {"view": 1.5, "click": 2.5}).alias("looked"), numbers.share(F.col("value"), e % 2, 2).alias("share"))


@bind("regex_classes", """SELECT p_partkey, regexp_matches(p_brand, '^Brand#1') AS first_brands, regexp_matches(coalesce(nullif(p_type, 'SMALL'), ''), '^[A-Z]+$') AS upper_type,
  CASE WHEN p_size % 3 = 0 OR p_type = 'SMALL' THEN 'none' WHEN p_size % 2 = 0 THEN 'domestic' ELSE 'international' END AS scope FROM part""")
def _(t):
    size = F.col("p_size")
    dep = F.when(size % 3 == 0, "ZZZZ").otherwise("SBGR")
    arr = F.when(F.col("p_type") == "SMALL", " ").when(size % 2 == 0, "SBSP").otherwise("EGLL")
    return t("part").select("p_partkey", text.matches(F.col("p_brand"), "^Brand#1").alias("first_brands"), text.matches(F.nullif(F.col("p_type"), F.lit("SMALL")), "^[A-Z]+$").alias("upper_type"), text.scope_class(dep, arr).alias("scope"))


@bind("json_props_flatten", "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, array_to_string([event_type, props->>'$.k'], '|') AS listed FROM events")
def _(t):
    got = F.from_json("props", "k long")
    return t("events").select("event_id", got["k"].alias("k"), text.flat_array(F.array(F.col("event_type"), got["k"].cast("string"))).alias("listed"))


from aeroperf.bindings import readback, reports  # noqa: E402, F401  (bind their queries)
