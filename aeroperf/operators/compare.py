"""Reports on two versions of one dataset: what one side lacks, why, and what it looks like.

Every function takes the two sides as tables of the same columns and gives
tables; which rows a comparison leaves out it counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroperf.config import MatchSpec
from aeroperf.functions.numbers import count_if, share
from aeroperf.functions.text import AIRLINE_CALLSIGN, HEX, REGISTRATION, clean, matches, scope_class
from aeroperf.functions.time import month_text
from aeroperf.operators import nearest, nearpairs
from aeroperf.operators.components import cut_lineage
from aeroperf.operators.reconcile import field_disagreement, keyed_diff, only_left, paired, shared


def _sides(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right")), allowMissingColumns=True)


def unmatched(left: DataFrame, right: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """All rows of either side whose key the other lacks, with their side: the audit trail."""
    return _sides(only_left(left, right, key), only_left(right, left, key))


def side_examples(left: DataFrame, right: DataFrame, key: tuple[str, ...], side: str, order: tuple[str, ...], n: int = 20) -> DataFrame:
    """The rows behind the counts, a report: the first ``n`` in ``order`` that only the left or the right has, or for ``both`` all rows of the first ``n`` shared keys."""
    if side == "both":
        some = shared(left, right, key).select(*key).distinct().orderBy(*key).limit(n)
        return _sides(shared(left, some, key), shared(right, some, key))
    one, other = (left, right) if side == "left" else (right, left)
    return only_left(one, other, key).withColumn("side", F.lit(side)).orderBy(*order).limit(n)


def both_examples(left: DataFrame, right: DataFrame, key: tuple[str, ...], order: tuple[str, ...], n: int = 10) -> DataFrame:
    """The first ``n`` rows in ``order`` that only one side has, of each side."""
    return side_examples(left, right, key, "left", order, n).unionByName(side_examples(left, right, key, "right", order, n), allowMissingColumns=True)


def identifier_shape(left: DataFrame, right: DataFrame, column: str, pattern: str = HEX) -> DataFrame:
    """One row a side: how many values an identifier has there, their lengths, whether all fit a pattern, and the least as an example. Null and empty ones don't count."""
    rows = _sides(left.select(column), right.select(column)).where(F.coalesce(F.col(column), F.lit("")) != "")
    return rows.groupBy("side").agg(F.count("*").alias("n"), F.min(F.length(column)).cast("long").alias("min_length"), F.max(F.length(column)).cast("long").alias("max_length"), F.bool_and(F.col(column).rlike(pattern)).alias("all_match"), F.min(column).alias("example"))


def identifier_examples(left: DataFrame, right: DataFrame, key: tuple[str, ...], columns: tuple[str, ...], order: tuple[str, ...], n: int = 10) -> DataFrame:
    """The same record from both sides, <column>_l beside <column>_r, for the first ``n`` shared keys: a report."""
    return paired(left, right, key, columns, order).orderBy(*key).limit(n)


def piece_overlap(left: DataFrame, right: DataFrame, pieces: dict[str, tuple[str, ...] | list[Column]], digits: int = 1) -> DataFrame:
    """Per part of a key: distinct values of the left, how many the right has too, and their share in percent. A null is a value. One shuffle for all parts."""
    said = lambda cs: F.concat_ws("\x1f", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\x00")) for c in cs])
    tall = lambda df: df.select(F.explode(F.array(*[F.struct(F.lit(name).alias("piece"), said(cs).alias("value")) for name, cs in pieces.items()])).alias("_p")).select("_p.*")
    d = keyed_diff(tall(left), tall(right), ("piece", "value"), ("piece",))
    return d.select("piece", "n_left", F.col("n_both").alias("shared"), share(F.col("n_both"), F.col("n_left"), digits).alias("pct_shared"))


def clock_offsets(left: DataFrame, right: DataFrame, key: tuple[str, ...], row_id: str, times: tuple[str, ...], split_by: str | None = None) -> DataFrame:
    """Per time column and rounded offset in minutes: right rows whose nearest left row of the key is that far away, and their share.

    No tolerance and no key with a time in it: a single dominant offset is a
    clock, and it shows whatever its size. ``split_by`` (day, month) cuts keys
    that hold too many rows for one task.
    """
    out = []
    for time in times:
        pairs = nearest.nearest(right, left, MatchSpec(key, row_id, row_id, time, time, float("inf"), null_key="group", split_by=split_by))
        out.append(nearest.offset_histogram(pairs.withColumn("diff_min", -F.col("diff_min"))).withColumn("time", F.lit(time)))
    tall = reduce(DataFrame.unionByName, out)
    total = tall.groupBy("time").agg(F.sum("n").alias("_all"))
    return tall.join(total, "time").select("time", "offset", "n", share(F.col("n"), F.col("_all"), 1).alias("pct"))


def untestable(residual: DataFrame, by: tuple[str, ...], time: str, callsign: str) -> DataFrame:
    """Per group: rows, those without a time, those without a callsign, and the share that no pass could ever pair."""
    no_time, no_call = F.col(time).isNull(), clean(F.col(callsign)).isNull()
    out = residual.groupBy(*by).agg(F.count("*").alias("residual"), count_if(no_time).alias("no_time"), count_if(no_call).alias("no_callsign"), count_if(no_time | no_call).alias("_u"))
    return out.select(*by, "residual", "no_time", "no_callsign", share(F.col("_u"), F.col("residual"), 1).alias("pct_untestable"))


def traffic_classes(df: DataFrame, by: tuple[str, ...], callsign: str) -> DataFrame:
    """Per group: rows whose callsign is a registration, an airline's, or neither."""
    reg, air = matches(F.col(callsign), REGISTRATION), matches(F.col(callsign), AIRLINE_CALLSIGN)
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), count_if(reg).alias("registration"), count_if(air).alias("airline"), count_if(~reg & ~air).alias("other"))


def scopes(df: DataFrame, by: tuple[str, ...], departure: str, arrival: str) -> DataFrame:
    """Per group: domestic and international rows, those without an aerodrome, and the international share."""
    scope = scope_class(F.col(departure), F.col(arrival))
    out = df.withColumn("_s", scope).groupBy(*by).agg(F.count("*").alias("n_rows"), *[count_if(F.col("_s") == s).alias(n) for s, n in (("domestic", "domestic"), ("international", "international"), ("none", "no_aerodrome"))])
    return out.withColumn("pct_international", share(F.col("international"), F.col("n_rows"), 1))


def busiest(df: DataFrame, by: tuple[str, ...], ends: tuple[str, ...], n: int = 10) -> DataFrame:
    """The ``n`` most frequent values of the given columns in each group, ties in their order: a report."""
    counts = df.select(*by, F.explode(F.array(*[F.col(c) for c in ends])).alias("value")).groupBy(*by, "value").agg(F.count("*").alias("n_rows"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n_rows"), "value"))
    return counts.withColumn("_n", place).where(F.col("_n") <= n).drop("_n")


def nearest_leftovers(left: DataFrame, right: DataFrame, spec: MatchSpec, end: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(all rows without a counterpart within the tolerance, with their side; MATCHED, ONLY_LEFT and ONLY_RIGHT in one row).

    ``end`` names the column whose equality with the time marks a plan; plans
    are left out on both sides.
    """
    if end:
        left, right = nearpairs.without_plans(left, spec.left_time, end)[0], nearpairs.without_plans(right, spec.right_time, end)[0]
    pairs = cut_lineage(nearest.match(left, right, spec))
    return _sides(*nearest.leftovers(left, right, spec, pairs)), nearest.match_summary(left, right, pairs)


def explained(left: DataFrame, right: DataFrame, spec: MatchSpec, passes: list[tuple[str, tuple[str, ...], float]], end: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(one row a pass in order: pass, n_paired, left_over, right_over; the rows that no pass paired, with their side).

    Each pass of (name, key, tolerance) works on what those before it left. Plans go first, as above.
    """
    if end:
        left, right = nearpairs.without_plans(left, spec.left_time, end)[0], nearpairs.without_plans(right, spec.right_time, end)[0]
    found = cut_lineage(nearest.cascade(left, right, spec, passes))
    order = left.sparkSession.createDataFrame([(i, name) for i, (name, _, _) in enumerate(passes)], "_i int, pass string")
    counts = order.join(found.groupBy("pass").agg(F.count("*").alias("n")), "pass", "left").withColumn("n_paired", F.coalesce("n", F.lit(0)))
    totals = left.agg(F.count("*").alias("_l")).crossJoin(right.agg(F.count("*").alias("_r")))  # single rows
    so_far = F.sum("n_paired").over(Window.orderBy("_i"))  # one row a pass
    steps = counts.crossJoin(totals).select("pass", "n_paired", (F.col("_l") - so_far).alias("left_over"), (F.col("_r") - so_far).alias("right_over"))
    return steps, _sides(*nearest.leftovers(left, right, spec, found))


def by_month(df: DataFrame, by: tuple[str, ...], time: str) -> DataFrame:
    """Rows by group and month; a spike in a residual is the edge of an extraction."""
    return df.groupBy(*by, month_text(F.col(time)).alias("month")).agg(F.count("*").alias("n_rows"))


def source_summary(left: DataFrame, right: DataFrame, key: tuple[str, ...], fields: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One row: rows, keys and repeats of either side, shared keys and those of one side, and shared keys whose first rows differ in a field (a null against a value differs)."""
    rows = lambda df, n: df.agg(F.count("*").alias(n))
    pairs = paired(left, right, key, fields, order)
    differs = reduce(lambda a, b: a | b, [~F.col(f"{f}_l").eqNullSafe(F.col(f"{f}_r")) for f in fields])
    # one row each
    out = keyed_diff(left, right, key).crossJoin(rows(left, "rows_left")).crossJoin(rows(right, "rows_right")).crossJoin(pairs.agg(count_if(differs).alias("field_diff")))
    return out.select("rows_left", "rows_right", F.col("n_left").alias("keys_left"), F.col("n_right").alias("keys_right"), (F.col("rows_left") - F.col("n_left")).alias("repeats_left"), (F.col("rows_right") - F.col("n_right")).alias("repeats_right"), F.col("n_both").alias("both"), "only_left", "only_right", "field_diff")


def difference_profile(left: DataFrame, right: DataFrame, key: tuple[str, ...], group: Column) -> DataFrame:
    """Where one-sided rows sit: group, only_left, only_right (rows, not keys), most first."""
    out = unmatched(left, right, key).groupBy(group.alias("group")).agg(count_if(F.col("side") == "left").alias("only_left"), count_if(F.col("side") == "right").alias("only_right"))
    return out.orderBy(F.desc(F.col("only_left") + F.col("only_right")), "group")


def differing_fields(left: DataFrame, right: DataFrame, key: tuple[str, ...], fields: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Per field how often the first rows of a shared key differ, most first."""
    return field_disagreement(paired(left, right, key, fields, order), fields).orderBy(F.desc("pct_different"), "field")
