"""Bound queries of sources and sinks: whole tables are written as a source has them, and read back."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroperf.bindings.driver import STAMP, VERSIONS_SQL, VISITS_SQL, bind, stamp, versions, visits
from aeroperf.config import MergeSpec
from aeroperf.functions import time
from aeroperf.operators import coverage, islands, nearpairs, reconcile
from aeroperf.sinks import files, incremental
from aeroperf.sources import catalog, delimited, json_dir, parquet


def spark_of(df: DataFrame):
    return df.sparkSession


def put(uri: str, data: bytes) -> None:
    """A file in the shared folder, whole or not at all."""
    store, path = pafs.FileSystem.from_uri(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(f"{path}.part") as f:
        f.write(data)
    store.move(f"{path}.part", path)


ORDERS_BY_YEAR = "SELECT o_orderkey::VARCHAR AS id, o_orderstatus AS status FROM orders"


@bind("separators_by_name", ORDERS_BY_YEAR)
def _(t):
    """Even years in annual files with semicolons, odd ones in monthly files with commas and an index column."""
    orders = t("orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("y"))
    folder, spark = files.scratch(spark_of(orders), "separators"), spark_of(orders)
    files.write_delimited(orders.where("y % 2 = 0").select("id", "status"), f"{folder}/k_even.csv")
    files.write_delimited(orders.where("y % 2 = 1").select(F.lit("7").alias("V1"), "id", "status"), f"{folder}/k_jan1995.csv", sep=",")
    return delimited.read_by_separator(spark, [f"{folder}/k_even.csv", f"{folder}/k_jan1995.csv"]).select("id", "status")


@bind("years_by_name", f"{ORDERS_BY_YEAR} WHERE year(o_orderdate) IN (1994, 1996)")
def _(t):
    orders = t("orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("y"))
    folder, spark = files.scratch(spark_of(orders), "years"), spark_of(orders)
    paths = [f"{folder}/orders_{y}.csv" for y in range(1992, 1999)]
    for y, path in zip(range(1992, 1999), paths):
        files.write_delimited(orders.where(F.col("y") == y).select("id", "status"), path)
    return delimited.read_delimited(spark, catalog.for_years(paths, {1994, 1996}), ["id", "status"])


@bind("zip_members", ORDERS_BY_YEAR)
def _(t):
    """An archive for each 20,000 order keys, with a member for each of its order states."""
    orders = t("orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"), F.floor(F.col("o_orderkey") / 20_000).alias("archive"))
    folder = files.scratch(spark_of(orders), "zips")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for status, own in rows.groupby("status"):
                z.writestr(f"sub/{status}.csv", own[["id", "status"]].to_csv(sep=";", index=False))
        put(f"{folder}/{rows['archive'].iloc[0]}.zip", out.getvalue())
        return pd.DataFrame({"n": [len(rows)]})

    orders.groupBy("archive").applyInPandas(pack, "n long").write.format("noop").mode("overwrite").save()
    return delimited.read_zipped(spark_of(orders), f"{folder}/*.zip", ["id", "status"])


@bind("newest_file", "SELECT o_orderkey, 'new' AS status FROM orders")
def _(t):
    orders = t("orders").select("o_orderkey")
    folder, spark = files.scratch(spark_of(orders), "newest"), spark_of(orders)
    for name, status in (("b_orders", "old"), ("c_orders", "new")):
        orders.withColumn("status", F.lit(status)).coalesce(1).write.parquet(f"{folder}/{name}")
    found = catalog.newest(spark, folder, r"\.parquet$")
    return spark.read.parquet(found)


@bind("json_days", """SELECT event_id::VARCHAR AS event_id, event_type, user_id::VARCHAR AS who_user, 'a|' || event_type AS tags FROM events""")
def _(t):
    """Events as files of 1,000, each one array of nested records."""
    events = t("events").select("event_id", "event_type", F.floor(F.col("event_id") / 1000).alias("file"), F.struct(F.col("user_id").alias("user")).alias("who"), F.array(F.lit("a"), "event_type").alias("tags"))
    folder = files.scratch(spark_of(events), "json-days")
    listed = events.groupBy("file").agg(F.to_json(F.collect_list(F.struct("event_id", "event_type", "who", "tags"))).alias("value"))
    listed.repartition(16, "file").write.partitionBy("file").text(folder)
    return json_dir.read_json_dir(spark_of(events), folder).select("event_id", "event_type", "who_user", "tags")


@bind("daily_table", """WITH e AS (SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS day FROM events), d AS (SELECT day, row_number() OVER (ORDER BY day) AS k FROM (SELECT DISTINCT day FROM e))
SELECT event_id, day FROM e JOIN d USING (day) WHERE k <> 2""")
def _(t):
    return daily_events(t).rows().select("event_id", F.col("day").cast("string").alias("day"))


@bind("daily_manifest", """WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1), d AS (SELECT *, row_number() OVER (ORDER BY day) AS k FROM e)
SELECT day, CASE WHEN k = 2 THEN 0 ELSE n END AS n, CASE k WHEN 1 THEN 'failed' WHEN 2 THEN 'empty' ELSE 'ok' END AS status FROM d""")
def _(t):
    """The rows that each day holds, and what was noted of it last."""
    table = daily_events(t)
    held = table.rows().groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))
    lines = table.manifest().select("day", "status")
    return lines.join(held, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"), "status")


def daily_events(t) -> incremental.DailyTable:
    """Events by day; then the second day comes again without a row, and the first fails and keeps what it had."""
    events = t("events").select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("_day"))
    spark = spark_of(events)
    table = incremental.DailyTable(spark, files.scratch(spark, "daily"))
    lines = events.groupBy(F.col("_day").alias("day")).agg(F.count("*").alias("n"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error"))
    table.store(events, lines, "2030-01-01")
    first, second = [r.day for r in lines.orderBy("day").limit(2).collect()]
    again = spark.createDataFrame([(first, 0, "failed", "gone"), (second, 0, "empty", None)], "day string, n long, status string, error string")
    table.store(events.limit(0), again, "2030-01-02")
    return table


@bind("available_columns", "SELECT p_partkey, p_size FROM part")
def _(t):
    part = t("part").select("p_partkey", "p_size", "p_name")
    folder = files.scratch(spark_of(part), "available")
    part.write.parquet(folder)
    if parquet.read_available(spark_of(part), folder, ["p_size"], ["absent"]) is not None:
        raise ValueError("a required column is missing")
    return parquet.read_available(spark_of(part), folder, ["p_partkey", "absent", "p_size"], ["p_partkey"])


@bind("lowered_headers", "SELECT p_partkey, p_brand FROM part")
def _(t):
    part = t("part")
    folder = files.scratch(spark_of(part), "lowered")
    part.toDF(*[c.upper() for c in part.columns]).write.parquet(folder)
    return delimited.lower_cased(spark_of(part).read.parquet(folder), ["p_partkey", "absent", "p_brand"])


@bind("stored_zone_period", "SELECT o_orderkey, strftime(o_orderdate - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS written FROM orders WHERE year(o_orderdate - INTERVAL 3 HOUR) = 1996 AND month(o_orderdate - INTERVAL 3 HOUR) = 3")
def _(t):
    """A month in the clock of a place three hours behind the stored instants."""
    orders = t("orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"))
    folder = files.scratch(spark_of(orders), "zone")
    orders.write.parquet(folder)
    return parquet.read_period(spark_of(orders), folder, "ts", 1996, 3, stored_zone="Etc/GMT+3").select("o_orderkey", stamp(F.col("ts")).alias("written"))


@bind("written_clock", "SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS written FROM events")
def _(t):
    return t("events").select("event_id", stamp(time.written_clock(F.col("ts").cast("timestamp"), "Etc/GMT+3")).alias("written"))


@bind("records_looked_up", f"WITH {VERSIONS_SQL} SELECT 'left' AS side, o_orderkey, priority FROM lv WHERE o_custkey % 10 = 3 UNION ALL SELECT 'right', o_orderkey, priority FROM rv WHERE o_custkey % 10 = 3")
def _(t):
    return reconcile.lookup_record(*versions(t), F.col("o_custkey") % 10 == 3, ("o_orderkey", "priority"))


@bind("sides_read_once", f"WITH {VERSIONS_SQL} SELECT 'only' AS kind, o_orderkey FROM lv WHERE NOT EXISTS (SELECT 1 FROM rv WHERE rv.o_orderkey = lv.o_orderkey) UNION ALL SELECT 'shared', o_orderkey FROM lv WHERE EXISTS (SELECT 1 FROM rv WHERE rv.o_orderkey = lv.o_orderkey)")
def _(t):
    both = reconcile.Sides(*[lambda columns, df=df: df.select(*columns) for df in versions(t)])
    left, right = both.get(("o_orderkey",))
    again, _ = both.get(("o_orderkey",))  # the same, not read again
    tag = lambda df, kind: df.select(F.lit(kind).alias("kind"), "o_orderkey")
    return tag(reconcile.only_left(left, right, ("o_orderkey",)), "only").unionByName(tag(reconcile.shared(again, right, ("o_orderkey",)), "shared"))


@bind("before_and_after_merge", f"WITH {VISITS_SQL} SELECT 'before' AS stage, user_id, {STAMP.format('s')} AS s FROM ev WHERE user_id % 2 = 0 UNION ALL SELECT 'after', user_id, {STAMP.format('min(s)')} FROM isl WHERE user_id % 2 = 0 GROUP BY user_id, island")
def _(t):
    rows = visits(t)
    spec = MergeSpec(("user_id",), "s", "e", order=("event_id",), gap_min=60.0)
    out = nearpairs.before_and_after(rows, islands.merged(rows, spec), F.col("user_id") % 2 == 0, ("user_id", "s"))
    return out.withColumn("s", stamp(F.col("s")))


@bind("absent_and_present_fields", "SELECT 'P_Size' AS field, count(p_size) AS filled FROM part")
def _(t):
    part = t("part")
    lacking = coverage.absent_fields(part, ("P_Size", "p-name", "colour"))
    held = [c for c in ("P_Size", "colour") if c not in lacking]
    return coverage.populated(part.withColumnRenamed("p_size", "P_Size"), tuple(held)).select("field", "filled")


@bind("payload_script", "SELECT 'window.DATA = {\"flags\":{' || string_agg('\"' || f || '\":{\"n\":' || n || '}', ',' ORDER BY f) || '}};' AS line FROM (SELECT l_returnflag AS f, count(*) AS n FROM lineitem GROUP BY ALL)")
def _(t):
    sums = t("lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"))
    path = f"{files.scratch(spark_of(sums), 'payload')}.js"
    files.write_payload({"flags": files.payload_json(sums, ("l_returnflag",), F.struct("n"))}, path)
    return spark_of(sums).read.text(path).withColumnRenamed("value", "line")


KEYS_SQL = "WITH e AS (SELECT event_id, event_type AS cs, 'D' || (user_id % 7) AS dep, 'A' || (user_id % 3) AS arr, ts FROM events), s AS (SELECT *, row_number() OVER (PARTITION BY cs, dep, arr, ts::DATE ORDER BY ts, event_id) AS seq FROM e) SELECT event_id, cs || '|' || dep || '|' || arr || '|' || strftime(ts, '%Y-%m-%d') AS flight_day, cs || '|' || dep || '|' || arr || '|' || strftime(ts, '%Y-%m-%d') || '|' || seq AS eobt_seq FROM s"


@bind("key_variants_split", KEYS_SQL)
def _(t):
    u, ts = F.col("user_id"), F.col("ts").cast("timestamp")
    e = t("events").select("event_id", F.col("event_type").alias("cs"), F.concat(F.lit("D"), u % 7).alias("dep"), F.concat(F.lit("A"), u % 3).alias("arr"), ts.alias("ts"), F.to_date(ts).alias("day"))
    return reconcile.key_variants(e, "cs", "dep", "arr", "day", "ts", "event_id", split=True).select("event_id", "flight_day", "eobt_seq")
