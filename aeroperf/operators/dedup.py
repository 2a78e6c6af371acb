"""Duplicates by key: keep one, count the surplus, or tell who repeats whom. All ties are broken by the order given."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroperf.operators.ordered import places


def _columns(order: tuple[str, ...], last: bool) -> list[Column]:
    return [F.col(c).desc_nulls_last() if last else F.col(c).asc_nulls_first() for c in order]


def keep_one(df: DataFrame, key: tuple[str, ...], order: tuple[str, ...], last: bool = False, null_key: str = "group") -> DataFrame:
    """The first (or last) row of each key by ``order``, which should be total.

    A null in the key is a value like any other, or with ``null_key='keep'``
    exempts its row, which then always stays. An aggregation rather than a
    window, so that rows combine before the shuffle and no key fills a task.
    """
    rest = [c for c in df.columns if c not in key]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    rows = df.where(whole) if null_key == "keep" else df
    by = F.struct(*[F.col(c) for c in order])
    pick = F.max_by if last else F.min_by
    out = rows.groupBy(*key).agg(pick(F.struct(*rest), by).alias("_row")).select(*key, "_row.*").select(*df.columns) if rest else rows.distinct()
    return out.unionByName(df.where(~whole)) if null_key == "keep" else out


def surplus(df: DataFrame, by: tuple[str, ...], key: tuple[str, ...]) -> DataFrame:
    """Per group of ``by``: rows, keys (a null is one), and rows beyond the first of their key; combined before the shuffle."""
    counts = df.groupBy(*by, *key).agg(F.count("*").alias("n"))
    return counts.groupBy(*by).agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), F.sum(F.col("n") - 1).alias("n_surplus"))


def distinct_rows(df: DataFrame, ignore: tuple[str, ...]) -> DataFrame:
    """Rows that differ in a column not in ``ignore``; of ignored ones the smallest value stays."""
    return df.groupBy(*[c for c in df.columns if c not in ignore]).agg(*[F.min(c).alias(c) for c in ignore]).select(*df.columns)


def numbered(df: DataFrame, key: tuple[str, ...], order: list[Column], name: str = "seq", split: bool = False) -> DataFrame:
    """Adds the place of a row within its key, from 1. ``split`` deals the rows of keys that no task should sort to many, by range (rows of equal ``order`` then stand in any order, as in a window)."""
    if split:
        return places(df, list(key), order, name)
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def sampled(df: DataFrame, key: tuple[str, ...], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows chosen by a hash of their key: the same ones on every run, whatever the partitions. Rows of a null key come last."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.concat_ws("|", *key))), *key).limit(n)


def group_roles(df: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Rows of keys that repeat, with group_size and role: original for the first in ``order``, repeat for the others.

    Rows that are equal in all of ``order`` are told apart by a hash of all
    columns; of rows equal throughout each counts as the first. Keys are
    summed up and joined, so that no key fills a task.
    """
    place = F.struct(*[F.col(c) for c in order], F.xxhash64(*df.columns))
    firsts = df.groupBy(*key).agg(F.count("*").alias("group_size"), F.min(place).alias("_first")).where("group_size > 1")
    firsts = firsts.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(key)})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)])
    out = df.withColumn("_place", place).join(firsts, same)
    role = F.when(F.col("_place").eqNullSafe(F.col("_first")), "original").otherwise("repeat")
    return out.withColumn("role", role).drop("_place", "_first", *[f"_k{i}" for i in range(len(key))])
