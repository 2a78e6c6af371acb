"""Files for people and pages: delimited text, yearly parquet, JSON payloads."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroperf.operators.reshape import nested


def guard_raw(path: str, raw_pattern: str = r"(^|/)data-raw(/|$)") -> str:
    """The path, unless it lies among raw data: those are never written to."""
    if re.search(raw_pattern, path):
        raise ValueError(f"{path} lies among raw data")
    return path


def scratch(spark: SparkSession, what: str) -> str:
    """A new path that the driver and all executors see: below ``spark.checkpoint.dir``, or in local mode below a temporary folder."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.gettempdir()}/{spark.sparkContext.applicationId}"
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"


def write_audit(df: DataFrame, path: str, order: tuple[str, ...]) -> None:
    """Rows to look up by hand, in order: quoted fields between semicolons, nulls blank. Sorted by range, so that a long trail is written by many tasks."""
    out = df.orderBy(*order)
    out.write.mode("overwrite").option("sep", ";").option("header", True).option("quoteAll", True).option("escape", '"').option("nullValue", "").option("emptyValue", "").csv(guard_raw(path))


def write_delimited(df: DataFrame, path: str, sep: str = ";", quote_all: bool = True, null: str = "", one_file: bool = False) -> None:
    """Delimited text with a header. ``one_file`` is for results of a few thousand rows: it writes through one task."""
    out = df.coalesce(1) if one_file else df
    out.write.mode("overwrite").option("sep", sep).option("header", True).option("quoteAll", quote_all).option("escape", '"').option("nullValue", null).option("emptyValue", "").csv(guard_raw(path))


def write_by_year(df: DataFrame, path: str, year: Column | str = "YEAR", others: tuple[str, ...] = ()) -> None:
    """Parquet partitioned by year; years that ``df`` doesn't hold stay as they are."""
    named = df.withColumn("YEAR", year) if isinstance(year, Column) else df.withColumnRenamed(year, "YEAR")
    named.write.partitionBy("YEAR", *others).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(guard_raw(path))


def payload_json(df: DataFrame, keys: tuple[str, ...], leaf: Column, digits: int = 6) -> DataFrame:
    """One row of JSON: nested maps by ``keys`` to the leaf, keys in order, nulls kept. Doubles are rounded by the caller's leaf or to ``digits``."""
    out = nested(df, keys, leaf)
    return out.select(F.to_json("payload", {"ignoreNullFields": "false"}).alias("json"))


def write_payload(parts: dict[str, DataFrame], path: str, variable: str = "DATA") -> None:
    """A script file that sets one variable to an object of the parts' JSON; parts are one row each."""
    path, body = guard_raw(path), ",".join(f'"{k}":{df.first()[0]}' for k, df in parts.items())
    spark = next(iter(parts.values())).sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(f"window.{variable} = {{{body}}};\n".encode())
    out.close()
