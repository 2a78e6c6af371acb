"""Nearest-in-time matching without a range join: one sorted union per key, looked at from both sides."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroperf.config import MatchSpec
from aeroperf.functions.time import minutes_between, shifted
from aeroperf.operators.components import cut_lineage


def nearest(left: DataFrame, right: DataFrame, spec: MatchSpec) -> DataFrame:
    """For each left row the right row of its key that is nearest in time, within the tolerance: key, left_id, right_id, left_time, right_time, diff_min.

    diff_min is right minus left, after ``shift_min`` is added to the left
    clock. Of two equally near the earlier wins, then the smaller id. Rows
    without a time never match; those with a null in the key match each other
    only with ``null_key='group'``. A key's rows are sorted in one task: one
    shuffle, no pairs; with ``split_by`` a day's or month's rows of a key are,
    and what stands before and after a part is carried in. Ids must be of one
    type on both sides.
    """
    part = lambda df, i, t, side, shift: df.select(*spec.key, F.col(i).alias("_id"), (shifted(F.col(t), shift) if shift else F.col(t).cast("timestamp")).alias("_t"), F.lit(side).alias("_side"))
    both = part(left, spec.left_id, spec.left_time, 1, spec.shift_min).unionByName(part(right, spec.right_id, spec.right_time, 0, 0)).where("_t is not null")
    if spec.null_key == "exclude":
        both = both.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in spec.key]))
    other = F.when(F.col("_side") == 0, F.struct("_t", "_id"))
    split = [F.date_trunc(spec.split_by, "_t").alias("_part")] if spec.split_by else []
    both = both.select("*", *split)
    by = Window.partitionBy(*spec.key, *["_part"] * bool(split))
    # at one time the right rows come first going forward (smallest id last) and first going back (smallest id last)
    forward = by.orderBy(F.col("_t"), F.col("_side"), F.col("_id").desc()).rowsBetween(Window.unboundedPreceding, 0)
    back = by.orderBy(F.col("_t").desc(), F.col("_side"), F.col("_id").desc()).rowsBetween(Window.unboundedPreceding, 0)
    got = both.withColumns({"_p": F.last(other, ignorenulls=True).over(forward), "_n": F.last(other, ignorenulls=True).over(back)}).where("_side = 1")
    if split:
        got = _carried(got, both, spec.key)
    gap = lambda c: F.abs(F.unix_micros(F.col(f"{c}._t")) - F.unix_micros("_t"))
    pick = F.when(F.col("_n").isNull() | (F.coalesce(gap("_p"), F.lit(2**62)) <= gap("_n")), F.col("_p")).otherwise(F.col("_n"))
    got = got.withColumn("_m", pick).where("_m is not null")
    out = got.select(*spec.key, F.col("_id").alias("left_id"), F.col("_m._id").alias("right_id"), F.col("_t").alias("left_time"), F.col("_m._t").alias("right_time"))
    return out.withColumn("diff_min", minutes_between(F.col("right_time"), F.col("left_time"))).where(F.abs("diff_min") <= spec.tolerance_min)


def _carried(got: DataFrame, both: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Where a part has no right row before or after a left one: the last of the parts before, the first of those after."""
    micros, right = F.unix_micros("_t"), F.col("_side") == 0
    row = F.struct("_t", "_id")
    ends = both.groupBy(*key, "_part").agg(F.min_by(F.when(right, row), F.when(right, F.struct(-micros, F.col("_id")))).alias("_last"), F.min_by(F.when(right, row), F.when(right, F.struct(micros, F.col("_id")))).alias("_first"))
    parts = Window.partitionBy(*key).orderBy("_part")
    ends = ends.withColumns({"_before": F.last("_last", ignorenulls=True).over(parts.rowsBetween(Window.unboundedPreceding, -1)), "_after": F.first("_first", ignorenulls=True).over(parts.rowsBetween(1, Window.unboundedFollowing))})
    names = [*key, "_part"]
    right_side = ends.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(names)], "_before", "_after")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(names)])
    out = got.join(right_side, same, "left").withColumns({"_p": F.coalesce("_p", "_before"), "_n": F.coalesce("_n", "_after")})
    return out.drop(*[f"_r{i}" for i in range(len(names))], "_before", "_after", "_part")


def _closest(df: DataFrame, side: str) -> DataFrame:
    rest = [c for c in df.columns if c != side]
    other = "right_id" if side == "left_id" else "left_id"
    best = F.min_by(F.struct(*rest), F.struct(F.abs("diff_min"), F.col(other)))
    return df.groupBy(side).agg(best.alias("_b")).select(side, "_b.*").select(*df.columns)


def one_to_one(pairs: DataFrame) -> DataFrame:
    """Each left row's closest pair, then of those each right row's closest; ties to the smaller id. Not a maximum matching."""
    return _closest(_closest(pairs, "left_id"), "right_id")


def match(left: DataFrame, right: DataFrame, spec: MatchSpec) -> DataFrame:
    return one_to_one(nearest(left, right, spec))


def leftovers(left: DataFrame, right: DataFrame, spec: MatchSpec, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of either side that no pair holds."""
    return (
        left.join(pairs.select(F.col("left_id").alias(spec.left_id)), spec.left_id, "left_anti"),
        right.join(pairs.select(F.col("right_id").alias(spec.right_id)), spec.right_id, "left_anti"),
    )


def match_summary(left: DataFrame, right: DataFrame, pairs: DataFrame) -> DataFrame:
    """MATCHED, ONLY_LEFT, ONLY_RIGHT in one row."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    out = n(pairs, "MATCHED").crossJoin(n(left, "_l")).crossJoin(n(right, "_r"))  # three single rows
    return out.select("MATCHED", (F.col("_l") - F.col("MATCHED")).alias("ONLY_LEFT"), (F.col("_r") - F.col("MATCHED")).alias("ONLY_RIGHT"))


def cascade(left: DataFrame, right: DataFrame, spec: MatchSpec, passes: list[tuple[str, tuple[str, ...], float]]) -> DataFrame:
    """Passes of (name, key, tolerance) over what earlier ones left unmatched: pass, left_id, right_id, diff_min."""
    found = []
    for name, key, tolerance in passes:
        own = replace(spec, key=key, tolerance_min=tolerance)
        pairs = cut_lineage(match(left, right, own).select(F.lit(name).alias("pass"), "left_id", "right_id", "diff_min"))
        found.append(pairs)
        left, right = leftovers(left, right, own, pairs)
    return reduce(DataFrame.unionByName, found)


def offset_histogram(pairs: DataFrame, value: str = "diff_min", top: int | None = None) -> DataFrame:
    """Counts of rounded offsets, most frequent first."""
    out = pairs.groupBy(F.round(value).alias("offset")).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), "offset").limit(top) if top else out


def modal_offset(pairs: DataFrame, by: tuple[str, ...], value: str = "diff_min") -> DataFrame:
    """The most frequent rounded offset of each group (ties to the smaller) and its share in percent."""
    n = pairs.groupBy(*by, F.round(value).alias("offset")).agg(F.count("*").alias("n"))
    # count and offset in one order: most rows, then the smallest offset
    out = n.groupBy(*by).agg(F.max_by("offset", F.struct(F.col("n"), -F.col("offset"))).alias("mode"), F.max("n").alias("n"), F.sum("n").alias("total"))
    return out.withColumn("share", F.round(F.col("n") * 100.0 / F.col("total"), 4))


def compatible(a: Column, b: Column) -> Column:
    """Equal, or one of them null or blank."""
    a, b = F.nullif(F.trim(a), F.lit("")), F.nullif(F.trim(b), F.lit(""))
    return a.isNull() | b.isNull() | (a == b)
