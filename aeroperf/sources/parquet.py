"""Parquet archives: a year or month by half-open bounds on the stored column, so that the scan skips the rest."""

from __future__ import annotations

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroperf.functions.time import stored_bounds, written_clock


def read_period(spark: SparkSession, path: str, ts: str, year: int, month: int | None = None, columns: list[str] | None = None, stored_zone: str = "UTC") -> DataFrame:
    """Rows of a year or month in written clock, columns that are there, and ``ts`` relabelled to the written clock.

    The bounds are moved to the stored zone instead of the column to the
    written one: the filter reaches the scan.
    """
    start = f"{year}-{month or 1:02d}-01"
    end = (f"{year + 1}-01-01" if month in (None, 12) else f"{year}-{month + 1:02d}-01")
    low, high = stored_bounds(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"), stored_zone)
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*[c for c in columns if c in df.columns])
    df = df.where((F.col(ts) >= low) & (F.col(ts) < high))
    return df.withColumn(ts, written_clock(F.col(ts), stored_zone)) if stored_zone != "UTC" else df


def stored_zones(path: str) -> dict[str, str | None]:
    """Zone labels of a local file's stamp columns, which Spark leaves out."""
    return {f.name: f.type.tz for f in pq.read_schema(path) if str(f.type).startswith("timestamp")}


def schema_info(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(name, type, whether a date is kept as text) of each column."""
    return [(n, t, t == "string" and n.lower().startswith(("dt", "dh"))) for n, t in df.dtypes]


def read_available(spark: SparkSession, path: str, wanted: list[str], required: list[str]) -> DataFrame | None:
    """Wanted columns that a table has, or None if a required one is missing."""
    df = spark.read.parquet(path)
    return df.select(*[c for c in wanted if c in df.columns]) if set(required) <= set(df.columns) else None
