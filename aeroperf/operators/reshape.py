"""Wide and long forms, ends to movements, nested payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def widened(df: DataFrame, ids: tuple[str, ...], by: str, levels: tuple[str, ...], values: tuple[str, ...], order: str | None = None) -> DataFrame:
    """One row per ``ids`` (a null is a value), with ``<level>_<value>`` columns; a level that is missing gives nulls.

    Of several rows of one level the first in ``order`` counts. Levels are
    listed, so no pass over the data looks for them.
    """
    pick = lambda v, level: F.min_by(F.when(F.col(by) == level, F.col(v)), F.when(F.col(by) == level, F.col(order) if order else F.lit(0)))
    return df.groupBy(*ids).agg(*[pick(v, level).alias(f"{level}_{v}") for level in levels for v in values])


def lengthened(df: DataFrame, ids: tuple[str, ...], by: str, levels: tuple[str, ...], values: tuple[str, ...]) -> DataFrame:
    """The inverse: one row per level, without levels whose values are all null."""
    parts = F.array(*[F.struct(F.lit(level).alias(by), *[F.col(f"{level}_{v}").alias(v) for v in values]) for level in levels])
    out = df.select(*ids, F.explode(parts).alias("_r")).select(*ids, "_r.*")
    return out.where(F.coalesce(*[F.col(v).cast("string") for v in values]).isNotNull())


def counts_wide(df: DataFrame, ids: tuple[str, ...], by: str, levels: tuple) -> DataFrame:
    """Counts by level as columns, 0 where there is none."""
    return df.groupBy(*ids).agg(*[F.count(F.when(F.col(by) == x, True)).alias(str(x)) for x in levels])


def ends_to_movements(df: DataFrame, departure: str, arrival: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row as two movements: place, phase (DEP, ARR)."""
    ends = F.array(F.struct(F.col(departure).alias("place"), F.lit("DEP").alias("phase")), F.struct(F.col(arrival).alias("place"), F.lit("ARR").alias("phase")))
    return df.select(*keep, F.explode(ends).alias("_m")).select(*keep, "_m.*")


def nested(df: DataFrame, keys: tuple[str, ...], leaf: Column) -> DataFrame:
    """One row: a map of the first key to a map of the second, and so on, to ``leaf``; keys in order.

    ``df`` has one row for each combination of keys. Each level combines
    within its own keys, so only the outermost map meets in one task; the
    result is meant for payloads, whose size is that of a dashboard.
    """
    out = df.select(*keys, leaf.alias("_leaf"))
    for i in range(len(keys) - 1, -1, -1):
        entries = F.array_sort(F.collect_list(F.struct(F.col(keys[i]).cast("string").alias("key"), F.col("_leaf").alias("value"))), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
        out = out.groupBy(*keys[:i]).agg(F.map_from_entries(entries).alias("_leaf"))
    return out.withColumnRenamed("_leaf", "payload")
