"""Percentile references from stored counts: a window or a refreshed month reads no row of any other month."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroperf.config import KpiSpec
from aeroperf.operators.kpi import is_valid
from aeroperf.sinks.snapshot import SnapshotTable


class ReferenceState:
    """How often each valid duration came, by key and day, in a ``SnapshotTable`` by month.

    Counts of days add up to those of any window of whole days, and a month that
    is fetched again takes the place of its own counts alone. The state has a row
    for each distinct value of a key and day, which for durations in minutes is
    far less than the rows. ``spec.window_col`` says which stamp a row counts by.
    """

    def __init__(self, spark: SparkSession, path: str, spec: KpiSpec):
        self.spec, self.table = spec, SnapshotTable(spark, path, ("year", "month"))

    def update(self, df: DataFrame, periods: list[tuple[int, int]]) -> int:
        """Replace the counts of months by those of ``df``'s rows; the version. A row of another month raises ValueError, one without a stamp takes no part."""
        spec, at = self.spec, F.col(self.spec.window_col).cast("timestamp")
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in spec.key])
        rows = df.where(is_valid(spec) & whole & at.isNotNull()).groupBy(*spec.key, F.to_date(at).alias("day"), F.col(spec.duration).alias("value")).agg(F.count("*").alias("n"))
        return self.table.replace(rows.withColumns({"year": F.year("day"), "month": F.month("day")}), periods, {"n": F.sum("n")})

    def counts(self, window: tuple[str, str] | None = None, version: int | None = None) -> DataFrame | None:
        """key, value, n of a window (both ends included) or of all days; only its months are read."""
        rows = self.table.read(version)
        if rows is None:
            return None
        if window:
            first, last = _days(window)
            month = F.col("year") * 12 + F.col("month")
            rows = rows.where(month.between(first.year * 12 + first.month, last.year * 12 + last.month) & F.col("day").between(F.lit(first.date()), F.lit(last.date())))
        return rows.groupBy(*self.spec.key, "value").agg(F.sum("n").alias("n"))

    def reference(self, window: tuple[str, str] | None = None, version: int | None = None) -> DataFrame | None:
        """``kpi.reference`` of the window, from counts alone: key, n, reference. None while there is no count."""
        rows = self.counts(window, version)
        if rows is None:
            return None
        out = rows.groupBy(*self.spec.key).agg(F.sum("n").alias("_n"), F.expr(f"percentile(value, {self.spec.p!r}D, n)").alias("reference"))
        return out.where(F.col("_n") >= self.spec.min_n).select(*self.spec.key, F.col("_n").alias("n"), "reference")


def _days(window: tuple[str, str]) -> tuple[datetime, datetime]:
    first, last = map(datetime.fromisoformat, window)
    if (first.hour, first.minute, first.second) != (0, 0, 0) or (last.hour, last.minute, last.second) != (23, 59, 59):
        raise ValueError(f"{window} is no window of whole days: from 00:00:00 to 23:59:59")
    return first, last
