"""Directories of JSON files, one array of records each: flattened to strings, with the file they came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroperf.functions.text import flat_array


def flattened(df: DataFrame, sep: str = "_") -> DataFrame:
    """Structs as columns ``outer_inner``, arrays of values as one text with ``|``, everything a string; an empty array is null."""

    def leaves(kind: T.StructType, at: Column | None, prefix: str) -> list[Column]:
        out = []
        for f in kind.fields:
            c = F.col(f"`{f.name}`") if at is None else at.getField(f.name)
            name = prefix + f.name
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, c, name + sep)
            elif isinstance(f.dataType, T.ArrayType):
                plain = not isinstance(f.dataType.elementType, (T.StructType, T.ArrayType, T.MapType))
                out.append((flat_array(c.cast("array<string>")) if plain else F.to_json(c)).alias(name))
            elif isinstance(f.dataType, T.MapType):
                out.append(F.to_json(c).alias(name))
            else:
                out.append(c.cast("string").alias(name))
        return out

    return df.select(*leaves(df.schema, None, ""))


def read_json_dir(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Records of all files, flattened, with source_file. Files with other columns are united; an empty array has no row.

    Without a schema Spark reads the files once more to find one.
    """
    reader = spark.read.option("multiLine", True)
    df = (reader.schema(schema) if schema else reader).json(path)
    return flattened(df.withColumn("source_file", F.col("_metadata.file_name")))
