"""Tables that grow by periods: each period is published when it is fetched, closed ones are left alone, repeats are resolved on merge."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroperf.operators.dedup import keep_one
from aeroperf.sinks.files import scratch
from aeroperf.sinks.snapshot import SnapshotTable
from aeroperf.sources.rest import Fetched, fetched


def _hadoop(spark: SparkSession, path: str):
    """(filesystem, path) of a URI."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _there(spark: SparkSession, pattern: str) -> bool:
    fs, p = _hadoop(spark, pattern)
    return bool(len(fs.globStatus(p) or []))


class IncrementalTable:
    """Rows by (year, month), and what was checked when, in one ``SnapshotTable``: both change together or not at all.

    A period without rows leaves a line in the manifest instead of a placeholder row.
    """

    MANIFEST = "year int, month int, n long, days int, checked_at string"

    def __init__(self, spark: SparkSession, path: str, ts: str, key: tuple[str, ...] = (), order: tuple[str, ...] = ()):
        self.spark, self.ts, self.key, self.order = spark, ts, key, order
        self.table = SnapshotTable(spark, path, ("year", "month"))

    def rows(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, the latest by default; None while no month has a row."""
        return self.table.read(version)

    def manifest(self, version: int | None = None) -> DataFrame:
        """The latest line of each period."""
        names = [f.split()[0] for f in self.MANIFEST.split(", ")]
        return self.spark.createDataFrame([tuple(n[c] for c in names) for n in self.table.notes(version)], self.MANIFEST)

    def pending(self, start: date, as_of: date, slack: int = 1) -> list[tuple[int, int]]:
        """Months from ``start`` to ``as_of`` still to fetch: not checked, short of days, or not yet over."""
        held = {(n["year"], n["month"]): n["days"] for n in self.table.notes()}
        out, at = [], date(start.year, start.month, 1)
        while at <= as_of:
            after = date(at.year + at.month // 12, at.month % 12 + 1, 1)
            open_still = as_of < after
            if open_still or held.get((at.year, at.month), -1) < (after - at).days - slack:
                out.append((at.year, at.month))
            at = after
        return out

    def store(self, df: DataFrame, periods: list[tuple[int, int]], checked_at: str) -> int:
        """Replace the months of ``periods`` by the rows of ``df``, and note all as checked; one without a row loses those it had. The version.

        A row of another month, or without a time, raises ValueError and
        changes nothing: it would replace a month that nobody asked for.
        """
        marked = df.withColumns({"year": F.year(self.ts), "month": F.month(self.ts)})
        if self.key:
            marked = keep_one(marked, self.key, self.order or (self.ts,), last=True, null_key="keep")
        measures = {"n": F.count("*"), "days": F.countDistinct(F.to_date(self.ts))}
        return self.table.replace(marked, periods, measures, {p: {"checked_at": checked_at} for p in periods})

    def refresh(self, fetch: Callable[[int, int], DataFrame], start: date, as_of: date) -> list[tuple[int, int]]:
        """Fetch and store each pending month on its own, so that a stop loses one month at most; the months fetched."""
        done = self.pending(start, as_of)
        for year, month in done:
            self.store(fetch(year, month), [(year, month)], as_of.isoformat())
        return done


class DailyTable:
    """Rows kept by the day they were fetched for, and a line for each day, in one ``SnapshotTable``.

    Days are fetched in stretches and each stretch is published as it comes, so
    that a stop loses one stretch at most. A day without traffic has a line and
    no row; one that failed keeps the rows it had.
    """

    MANIFEST = "day string, n long, status string, error string, checked_at string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, SnapshotTable(spark, path, ("day",))

    def rows(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, the latest by default; None while no day has a row."""
        return self.table.read(version)

    def manifest(self, version: int | None = None) -> DataFrame:
        """The latest line of each day."""
        names = [f.split()[0] for f in self.MANIFEST.split(", ")]
        return self.spark.createDataFrame([tuple(n[c] for c in names) for n in self.table.notes(version)], self.MANIFEST)

    def pending(self, start: date, as_of: date) -> list[date]:
        """Days still to fetch: never fetched, failed, or fetched on the day itself or before it was over; ``as_of`` always is."""
        held = {n["day"]: n["checked_at"] for n in self.table.notes() if n["status"] != "failed"}
        every = [start + timedelta(days=i) for i in range((as_of - start).days + 1)]
        return [d for d in every if d == as_of or held.get(d.isoformat(), "") <= d.isoformat()]

    def store(self, rows: DataFrame, days: DataFrame, checked_at: str, batch: tuple[str, int] | None = None) -> int:
        """Publish fetched days: ``rows`` with their _day, and ``days`` (day, n, status, error), a line each. The version."""
        lines = {(r.day,): {"n": r.n, "status": r.status, "error": r.error, "checked_at": checked_at} for r in days.collect()}
        told = [day for day, line in lines.items() if line["status"] != "failed"]
        return self.table.replace(rows.withColumnRenamed("_day", "day"), told, notes=lines, batch=batch)

    def refresh(self, fetch: Callable[[list[date]], Fetched], start: date, as_of: date, every: int = 5) -> DataFrame:
        """Fetch pending days, ``every`` at a time; the manifest afterwards. ``fetch`` gives (rows with _day, days), as ``fetch_days`` does."""
        todo = self.pending(start, as_of)
        for at in range(0, len(todo), every):
            got = fetch(todo[at : at + every])
            self.store(*got, as_of.isoformat())
            getattr(got, "discard", lambda: None)()
        return self.manifest()


    def follow(self, stream: DataFrame, checkpoint: str, today: Callable[[], str] = lambda: date.today().isoformat()):
        """A stream of ``RestSource`` with _day and _end into the table, by day; returns the writer, not started.

        A batch is fetched once and written, and its days are published in one
        version that names the batch: one that is run again changes nothing.
        """

        def write(batch: DataFrame, number: int) -> None:
            path = scratch(self.spark, "streamed-days")
            batch.write.parquet(path)
            got = fetched(self.spark.read.schema(batch.schema).parquet(path))
            self.store(*got, today(), batch=(checkpoint, number))
            got.discard()

        return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def prepare_months(spark: SparkSession, path: str, prepare: Callable[[int, int], DataFrame], years: tuple[int, ...], as_of: date, months: tuple[int, ...] | None = None, force: bool = False) -> list[tuple[int, int]]:
    """Write ``prepare(year, month)`` below ``path``/year=/month= for each closed month that is not there yet; the months written.

    Without ``months`` only those that were over before ``as_of`` count. A
    month is there once its write has ended; one without rows is written again
    next time. ``force`` writes all again.
    """
    done = []
    for year in years:
        closed = 12 if year < as_of.year else as_of.month - 1 if year == as_of.year else 0
        for month in months or range(1, closed + 1):
            at = f"{path}/year={year}/month={month}"
            if not force and _there(spark, f"{at}/_SUCCESS"):
                continue
            rows = prepare(year, month).persist()
            if not rows.isEmpty():
                rows.write.mode("overwrite").parquet(at)
                done.append((year, month))
            rows.unpersist()
    return done


def merged_update(old: DataFrame, new: DataFrame, periods: DataFrame, ts: str, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Old rows outside the refetched periods (year, month), with the new ones; of one key the last in ``order`` stays, null keys all."""
    own = old.withColumns({"_y": F.year(ts), "_m": F.month(ts)})
    kept = own.join(periods.select(F.col("year").alias("_y"), F.col("month").alias("_m")), ["_y", "_m"], "left_anti").drop("_y", "_m")
    both = kept.unionByName(new, allowMissingColumns=True)
    return keep_one(both, key, order, last=True, null_key="keep") if key else both
