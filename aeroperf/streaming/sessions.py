"""Islands, days and repeats on streams, by Structured Streaming's own state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroperf.operators.dedup import keep_one


def island_sessions(events: DataFrame, key: tuple[str, ...], start: str, end: str, gap_min: float, late: str) -> DataFrame:
    """Records chained while one starts within ``gap_min`` of the latest end: key, start, end, n.

    A session's gap is that record's own length plus the gap, so a long record
    holds its island open. An island is given out once the watermark, ``late``
    behind the newest start, has passed its end. Works on batches too. Rows
    without a start are left out; a null end or one before the start is the start.
    """
    s = F.col(start).cast("timestamp")
    e = F.greatest(s, F.coalesce(F.col(end).cast("timestamp"), s))
    rows = events.where(s.isNotNull()).select(*key, s.alias("_s"), e.alias("_e")).withWatermark("_s", late)
    micros = F.unix_micros("_e") - F.unix_micros("_s") + F.lit(round(gap_min * 60e6) + 1)  # a gap of exactly gap_min joins
    length = F.concat(micros.cast("string"), F.lit(" microseconds"))
    out = rows.groupBy(*key, F.session_window("_s", length)).agg(F.min("_s").alias("start"), F.max("_e").alias("end"), F.count("*").alias("n"))
    return out.drop("session_window")


def daily_counts(events: DataFrame, ts: str, by: tuple[str, ...], late: str) -> DataFrame:
    """Rows per day and group; a late row amends its day until the watermark has passed it (update mode)."""
    rows = events.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", late)
    return rows.groupBy(*by, F.window("_t", "1 day").alias("_w")).agg(F.count("*").alias("n")).select(*by, F.to_date("_w.start").alias("day"), "n")


def first_of_each(events: DataFrame, key: tuple[str, ...], ts: str, late: str) -> DataFrame:
    """The first row of each key to arrive within the watermark; state is bounded by it."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark(list(key))


def refresh_months(events: DataFrame, ts: str, path: str, checkpoint: str):
    """A stream of part files into a table by month and micro-batch; returns the writer, not started.

    A batch adds to its months and replaces nothing but its own earlier try, so
    a month in two batches keeps both and a late row wipes no closed month.
    ``refreshed`` reads the table, with the latest row of each key.
    """

    def write(batch: DataFrame, number: int) -> None:
        marked = batch.withColumns({"year": F.year(ts), "month": F.month(ts), "batch": F.lit(number)})
        marked.write.partitionBy("year", "month", "batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def refreshed(table: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """What ``refresh_months`` wrote: of each key the row of the last batch, and in one batch the last in ``order``; null keys all. ``year`` and ``month`` stay."""
    return keep_one(table, key, ("batch", *order), last=True, null_key="keep").drop("batch")
