"""Delimited text: everything is a string, ragged rows keep their extra fields, blanks are nulls."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroperf.functions.text import flat_name


def strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_delimited(spark: SparkSession, paths: str | list[str], names: list[str] | None = None, sep: str = ";", extra: tuple[str, ...] = (), with_origin: bool = False) -> DataFrame:
    """Rows of one or more files with a header, as strings.

    With ``names`` columns go by place, and ``extra`` names the fields that
    some rows have beyond the header (an inferred schema drops them silently).
    ``with_origin`` adds _file, _block (the byte at which a task's stretch of
    the file begins) and _seq (the row's place in its task): a file's rows are
    in the order of (_block, _seq), however it is split.
    """
    reader = spark.read.option("sep", sep).option("header", True).option("nullValue", "").option("escape", '"').option("mode", "PERMISSIVE").option("enforceSchema", True)
    df = reader.schema(strings([*names, *extra])).csv(paths) if names else reader.csv(paths)
    if not with_origin:
        return df
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.withColumns({"_file": F.col("_metadata.file_name"), "_block": F.col("_metadata.file_block_start"), "_seq": place})


def numbered_lines(df: DataFrame, name: str = "line") -> DataFrame:
    """Rows that were read ``with_origin``, with one number over all files, from 1: files by name, rows as they stand in them.

    Rows are counted by split, a row for each split goes through a window, and
    the rows of the splits before are added to a row's place in its own; no row
    is shuffled but to be joined with its split's count.
    """
    splits = df.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.withColumn("_ahead", before).drop("_n")
    return df.join(splits, ["_file", "_block"]).withColumn(name, F.col("_ahead") + F.col("_seq") - F.col("_first") + 1).drop("_ahead", "_first")


def header(spark: SparkSession, path: str, sep: str = ";") -> list[str]:
    """Column names alone, from the first line; quotes and a leading index column are left off."""
    line = spark.read.text(path).first()
    names = [re.sub("^[\"']|[\"']$", "", x) for x in line[0].split(sep)] if line else []
    return [n for n in names if n not in ("", "V1")]


def read_by_separator(spark: SparkSession, paths: list[str], comma_names: str = r"_[a-z]{3}\d{4}\.csv$") -> DataFrame:
    """Annual files (``;``) and monthly ones (``,`` with a leading index), told apart by name, in one table."""
    kinds = {",": [p for p in paths if re.search(comma_names, p)], ";": [p for p in paths if not re.search(comma_names, p)]}
    parts = []
    for sep, some in kinds.items():
        if some:
            df = spark.read.option("sep", sep).option("header", True).option("nullValue", "").option("escape", '"').csv(some)
            df = df.toDF(*[re.sub("[\"']", "", c) for c in df.columns])
            parts.append(df.drop("_c0", "V1"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_zipped(spark: SparkSession, path: str, names: list[str], sep: str = ";", encoding: str = "utf-8") -> DataFrame:
    """All members of zip files, row by row as strings.

    The archives' tables of contents are read first; then members are dealt
    over tasks, each of which seeks to its member and streams it, so that
    neither an archive's size nor a member's is held, and archives of many
    members are read by many tasks.
    """

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in batch["path"]:
                with opened(at) as f, zipfile.ZipFile(f) as z:
                    yield pd.DataFrame({"path": at, "member": [m.filename for m in z.infolist() if not m.is_dir()]})

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, member in zip(batch["path"], batch["member"]):
                with opened(at) as raw, zipfile.ZipFile(raw) as z, z.open(member) as f:
                    for part in pd.read_csv(f, sep=sep, names=names, header=0, dtype=str, encoding=encoding, keep_default_na=False, na_values=[""], chunksize=50_000):
                        yield part.astype(object).where(part.notna(), None)

    listed = spark.read.format("binaryFile").load(path).select("path").mapInPandas(members, "path string, member string")
    tasks = 4 * spark.sparkContext.defaultParallelism
    return listed.repartition(tasks, "path", "member").mapInPandas(rows, strings(names))


def opened(uri: str):
    """A file of any store, to read and seek in."""
    fs, name = pafs.FileSystem.from_uri(uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)
    return fs.open_input_file(name)


def renamed(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Columns under the names of ``wanted`` (source spelling to own), matched without case and underscores; others stay."""
    to = {flat_name(k): v for k, v in wanted.items()}
    return df.toDF(*[to.get(flat_name(c), c) for c in df.columns])


def lower_cased(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Headers in lower case, and of ``columns`` those that are there."""
    df = df.toDF(*[c.lower() for c in df.columns])
    return df.select(*[c for c in columns if c in df.columns]) if columns else df


def read_typed(spark: SparkSession, path: str, schema: str, sep: str = ",", null: str = "NA") -> DataFrame:
    """A result file under an explicit schema (dates as text stay text); a value that doesn't fit its type is an error."""
    return spark.read.option("sep", sep).option("header", True).option("nullValue", null).option("escape", '"').option("mode", "FAILFAST").schema(schema).csv(path)
