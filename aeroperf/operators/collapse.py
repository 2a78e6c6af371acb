"""Lossless merges: records with one key, and canonical lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroperf.functions.text import canonical_list, first_filled, union_of_lists
from aeroperf.operators.ordered import filled_state, in_two_steps, total, union_state


def collapse_same_key(df: DataFrame, key: str, order: tuple[str, ...], union_cols: tuple[str, ...] = (), normal: Column | None = None, count: str = "N_KEY_MERGED", split: bool = False) -> DataFrame:
    """One row per normalised key (``normal``, upper case of the key by default), adding the number of rows merged.

    Columns of ``union_cols`` become the canonical list of all tokens; any other
    takes its first filled value in ``order``. The key keeps its first spelling.
    Rows whose key is null or blank are never merged, and count 1. ``split`` is
    for keys of very many rows: those are dealt by ``order`` to as many tasks as
    they need, and states of a bounded size are put together.
    """
    normal = F.upper(F.trim(F.col(key))) if normal is None else normal
    df = df.withColumn("_k", F.nullif(normal, F.lit("")))
    by = F.struct(*[F.col(c) for c in order])
    columns = [c for c in df.columns if c != "_k"]
    rows = df.where("_k is not null")
    if split:
        states = [union_state(c) if c in union_cols else filled_state(c, by) for c in columns]
        merged = in_two_steps(rows, ["_k"], [by], [*states, total(count, F.count("*"))])
    else:
        merged = rows.groupBy("_k").agg(*[(union_of_lists(F.col(c)) if c in union_cols else first_filled(F.col(c), by)).alias(c) for c in columns], F.count("*").alias(count))
    alone = df.where("_k is null").select(*[canonical_list(F.col(c)).alias(c) if c in union_cols else F.col(c) for c in columns], F.lit(1).cast("long").alias(count))
    return merged.drop("_k").unionByName(alone)


def canonical_columns(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Lists in text in their one spelling; a value without a separator is only trimmed."""
    return df.withColumns({c: canonical_list(F.col(c)) for c in columns})


def had_repeats(c: Column) -> Column:
    """Whether a list names a token more than once."""
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "[\\|,]"), F.trim), lambda x: x != "")
    return F.size(parts) > F.size(F.array_distinct(parts))
