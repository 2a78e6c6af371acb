"""Hot groups in order: rows dealt to tasks by range, states of each chunk, and what the chunks make together.

A window or a ``collect_list`` over a group holds the group in one task. Here the
rows of a group are dealt by range to as many tasks as they need, each task
makes a bounded state of its stretch, and states are put together in the order
of the chunks. The bounds of a range exchange are drawn once a job, so a task
that is run again deals its rows as before.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroperf.functions.text import filled, union_of_lists
from aeroperf.operators.components import cut_lineage

#: Rows that a task sorts at a time, and rows of a table of chunks that are sent to all tasks.
CHUNK_ROWS, SENT_ROWS = 250_000, 50_000


@dataclass(frozen=True)
class State:
    """A column that is aggregated in two steps: over the rows of a chunk, and over the chunks (where it has the same name)."""

    name: str
    partial: Column
    final: Column

    def whole(self) -> Column:
        return self.partial.alias(self.name)


def total(name: str, partial: Column, final=F.sum) -> State:
    """An aggregate that ``final`` puts together: sums, least and greatest values."""
    return State(name, partial, final(name))


def union_state(name: str) -> State:
    """The canonical list of all tokens; a chunk holds its distinct tokens."""
    return State(name, union_of_lists(F.col(name)), union_of_lists(F.col(name)))


def filled_state(name: str, order: Column) -> State:
    """The first filled value in ``order``; a chunk holds its own, and where it stands."""
    first = F.min_by(F.struct(order.alias("o"), F.col(name).alias("v")), F.when(filled(F.col(name)), order))
    return State(name, first, F.min_by(F.col(f"{name}.v"), F.col(f"{name}.o")))


def joined_state(name: str, value: Column, order: Column, sep: str = "|") -> State:
    """All values in ``order``, joined; null values are left out. A chunk holds its own, joined."""
    in_order = lambda x: F.array_join(F.transform(F.array_sort(F.collect_list(x)), lambda r: r["v"]), sep)
    return State(name, in_order(F.struct(order.alias("o"), value.alias("v"))), in_order(F.struct(F.col("_chunk").alias("o"), F.nullif(F.col(name), F.lit("")).alias("v"))))


def placed_state(name: str, value: Column) -> State:
    """The first of values that come with their place (o and v), place and all."""
    return State(name, F.min_by(value, value["o"]), F.min_by(F.col(name), F.col(name)["o"]))


def records_state(name: str, records: Column) -> State:
    """All records of arrays of them (o and v), in no order yet."""
    return State(name, F.flatten(F.collect_list(records)), F.flatten(F.collect_list(name)))


def joined_records(name: str, sep: str = "|") -> Column:
    return F.array_join(F.transform(F.array_sort(name), lambda r: r["v"]), sep)


def dealt(df: DataFrame, group: list[str], order: list[Column], chunks: int | None = None) -> DataFrame:
    """Adds _chunk: rows of a group lie in chunks that follow one another in ``order``; nulls come first. ``chunks``: how many, else as many as a shuffle has partitions."""
    return df.repartitionByRange(*([chunks] if chunks else []), *group, *order).withColumn("_chunk", F.spark_partition_id())


def in_two_steps(df: DataFrame, group: list[str], order: list[Column], states: list[State]) -> DataFrame:
    """One row a group, by states of its chunks."""
    first = dealt(df, group, order).groupBy(*group, "_chunk").agg(*[s.partial.alias(s.name) for s in states])
    return first.groupBy(*group).agg(*[s.final.alias(s.name) for s in states])


def carried(df: DataFrame, group: list[str], chunk: str, values: dict[str, tuple[Column, object]]) -> DataFrame:
    """Adds, by name, what an aggregate of a value comes to over the earlier chunks of a group; one row a chunk goes through a window."""
    by = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    chunks = df.groupBy(*group, chunk).agg(*[how(value).alias(name) for name, (value, how) in values.items()])
    chunks = chunks.withColumns({name: how(name).over(by) for name, (_, how) in values.items()})
    names = [*group, chunk]
    right = chunks.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(names)], *values)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(names)])
    return df.join(right, same, "left").drop(*[f"_r{i}" for i in range(len(names))])


def places(df: DataFrame, group: list[str], order: list[Column], name: str, most: int = CHUNK_ROWS) -> DataFrame:
    """Adds the place of a row within its group, from 1: that in its chunk, and the rows of the chunks before.

    A task sorts one chunk of about ``most`` rows, however many there are: rows
    are counted first, dealt to so many chunks, and written once, sorted and
    numbered in passing. They are not dealt or sorted again: where a group
    begins in a chunk comes from a table of one row a group and chunk.
    """
    rows = dealt(df, group, order, max(1, -(-df.count() // most))).sortWithinPartitions(*group, *order)
    rows = cut_lineage(rows.withColumn("_at", F.monotonically_increasing_id()))
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*group, "_chunk").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    starts = starts.withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1)
    names = [*group, "_chunk"]
    starts = cut_lineage(starts.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(names)], "_shift"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(names)])
    # many groups are joined by key; few are sent to the rows, which stay where they are
    starts = F.broadcast(starts) if starts.count() <= SENT_ROWS else starts
    return rows.join(starts, same).withColumn(name, (F.col("_at") + F.col("_shift")).cast("int")).drop("_chunk", "_at", "_shift", *[f"_r{i}" for i in range(len(names))])
