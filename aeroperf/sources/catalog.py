"""Which files there are: lookup, pruning by name, inventories."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroperf.operators.components import cut_lineage
from aeroperf.sources.delimited import opened


def resolve(name: str, folders: list[str]) -> str:
    """The first folder's file of that name; FileNotFoundError names all folders."""
    for folder in folders:
        if os.path.exists(path := os.path.join(folder, name)):
            return path
    raise FileNotFoundError(f"{name} is in none of {', '.join(folders)}")


def newest(spark: SparkSession, folder: str, pattern: str = "") -> str:
    """Path of the file below a folder whose name fits and that was modified last (of several the last by name); FileNotFoundError without any."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "modificationTime").where(F.element_at(F.split("path", "/"), -1).rlike(pattern))
    last = found.orderBy(F.desc("modificationTime"), F.desc("path")).first()
    if last is None:
        raise FileNotFoundError(f"no file in {folder} fits {pattern!r}")
    return last.path


def analytic_name(project: str, region: str, table: str, period: int | tuple[int, int], reference_year: int | None = None, variant: str | None = None, kind: str = "csv") -> str:
    """Name of a result file: project, region, table, year or first and last year, reference year and variant."""
    years = str(period) if isinstance(period, int) else f"{period[0]}-{period[1]}"
    parts = [project, region, table, years, f"ref{reference_year}" if reference_year else "", variant or ""]
    return "-".join(p for p in parts if p) + f".{kind}"


def analytic_pattern(project: str, region: str, table: str, reference_year: int, variant: str, kind: str = "csv") -> str:
    """A pattern for such names of any year from 2000 to 2099."""
    return f"^{'-'.join(map(re.escape, (project, region, table)))}-20[0-9]{{2}}-ref{reference_year}-{re.escape(variant)}\\.{kind}$"


def for_years(paths: list[str], years: set[int]) -> list[str]:
    """Paths whose name holds one of the years, or none at all."""
    named = {p: {int(y) for y in re.findall(r"(?<!\d)((?:19|20)\d\d)(?!\d)", os.path.basename(p))} for p in paths}
    return [p for p, found in named.items() if not found or found & years]


@dataclass
class Sources:
    parquet: list[str] = field(default_factory=list)
    csv: list[str] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)


def find_sources(folder: str, include_parts: bool = False, env: str | None = None) -> Sources:
    """Parquet archives, CSV files and, if asked for, month parts below a folder or the one an environment variable names."""
    root, out = os.environ.get(env or "", folder) if env else folder, Sources()
    for at, _, names in sorted(os.walk(root)):
        for n in sorted(names):
            path = os.path.join(at, n)
            if n.endswith(".parquet"):
                out.parquet.append(path)
            elif re.search(r"\d{4}-\d{2}\.csv$", n) and include_parts:
                out.parts.append(path)
            elif n.endswith(".csv") and not re.search(r"\d{4}-\d{2}\.csv$", n):
                out.csv.append(path)
    return out


def inventory(spark: SparkSession, df: DataFrame, folder: str, ts: str) -> DataFrame:
    """One row per file of a table: file, size, modified, rows, first and last stamp."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    held = df.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"), F.min(ts).alias("first"), F.max(ts).alias("last"))
    return files.join(held, "file", "left")


def footers(spark: SparkSession, folder: str, ts: str) -> DataFrame:
    """``inventory`` of Parquet files from their footers: path, size, modified, rows, first and last stamp, scanned.

    Footers are read by many tasks, and no row is. A file whose footer has no
    bounds of ``ts`` (stamps of an old kind, no statistics, bounds cut short) is
    scanned, and says so. A file without rows, or without a stamp, has null bounds.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    listed = listed.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    told = listed.repartition(4 * spark.sparkContext.defaultParallelism, "path").mapInPandas(_footers(ts), "path string, rows long, first_us long, last_us long, known boolean")
    told = cut_lineage(told)  # each footer is read once
    missing = [r.path for r in told.where("not known").select("path").collect()]
    at = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("path")
    found = told.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"), "rows", F.timestamp_micros("first_us").alias("first"), F.timestamp_micros("last_us").alias("last"), (~F.col("known")).alias("scanned"))
    if missing:
        rows = spark.read.parquet(*missing)
        bounds = rows.groupBy(at).agg(F.min(F.col(ts).cast("timestamp")).alias("_first"), F.max(F.col(ts).cast("timestamp")).alias("_last"))
        found = found.join(bounds, "path", "left").select("path", "rows", F.coalesce("first", "_first").alias("first"), F.coalesce("last", "_last").alias("last"), "scanned")
    return listed.withColumn("path", F.regexp_replace("path", "^file:/+", "file:/")).join(found, "path")


def _footers(ts: str):
    """Paths to rows and bounds (in microseconds since 1970) that the files' footers tell."""

    def run(batches):
        for batch in batches:
            out = []
            for path in batch["path"]:
                with opened(path) as f:
                    meta = pq.read_metadata(f)
                low, high, known = [], [], True
                at = {meta.schema.column(i).path: i for i in range(meta.num_columns)}.get(ts)
                for g in range(meta.num_row_groups):
                    stats = meta.row_group(g).column(at).statistics if at is not None else None
                    if stats is not None and stats.has_null_count and stats.null_count == meta.row_group(g).num_rows:
                        continue
                    if stats is None or not stats.has_min_max or stats.physical_type != "INT64" or stats.logical_type.type != "TIMESTAMP":
                        known = known and meta.row_group(g).num_rows == 0
                        continue
                    low.append(_micros(stats.min))
                    high.append(_micros(stats.max))
                out.append((path, meta.num_rows, min(low) if known and low else None, max(high) if known and high else None, known))
            yield pd.DataFrame(out, columns=["path", "rows", "first_us", "last_us", "known"]).astype({"first_us": "Int64", "last_us": "Int64"})

    return run


def _micros(stamp) -> int:
    """Of a stamp of a footer, in UTC or without a zone."""
    return pd.Timestamp(stamp).tz_localize("UTC").value // 1000 if pd.Timestamp(stamp).tzinfo is None else pd.Timestamp(stamp).value // 1000


def from_file_name(df: DataFrame, pattern: str, names: tuple[str, ...]) -> DataFrame:
    """Columns captured from the name of each row's file; null where the pattern doesn't fit."""
    file = F.col("_metadata.file_name")
    return df.withColumns({n: F.nullif(F.regexp_extract(file, pattern, i + 1), F.lit("")) for i, n in enumerate(names)})
