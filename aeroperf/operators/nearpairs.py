"""Near duplicates inside one table: plans beside movements, consecutive repeats, and what they merge to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeroperf.config import NEAR_MIN, PLAN_TOLERANCE_MIN, MatchSpec, MergeSpec
from aeroperf.functions.numbers import count_if
from aeroperf.functions.time import is_midnight, minutes_between
from aeroperf.operators.components import connected_components
from aeroperf.operators.dedup import surplus
from aeroperf.operators.islands import merged
from aeroperf.operators.nearest import compatible, match

PLAN_AND_MOVEMENT, REPEATED_PLAN, REPEATED_MOVEMENT = "plan + movement", "repeated plan", "repeated movement"


def with_plan_flag(df: DataFrame, start: str, end: str) -> DataFrame:
    """Adds is_plan: both stamps are there and equal."""
    return df.withColumn("is_plan", F.coalesce(F.col(start) == F.col(end), F.lit(False)))


def near_pairs(df: DataFrame, key: tuple[str, ...], row_id: str, start: str, end: str, registration: str, near_min: float = NEAR_MIN, plan_min: float = PLAN_TOLERANCE_MIN, split_by: str | None = None) -> DataFrame:
    """row_id, partner_id, gap_min, kind: each plan's nearest movement (one to one), and consecutive repeats.

    Repeats are consecutive rows of one kind in a key, at most ``near_min``
    apart, whose registrations are equal or missing. Rows without a start or
    with a null in the key take no part. A pair found twice keeps its first kind.
    ``split_by`` (day, month) cuts keys that hold too many rows for one task.
    """
    rows = with_plan_flag(df, start, end).where(F.col(start).isNotNull())
    for k in key:
        rows = rows.where(F.col(k).isNotNull())
    plans, moves = rows.where("is_plan"), rows.where("not is_plan")
    spec = MatchSpec(key, row_id, row_id, start, start, plan_min, split_by=split_by)
    first = match(plans, moves, spec).select(F.col("left_id").alias("row_id"), F.col("right_id").alias("partner_id"), F.abs("diff_min").alias("gap_min"), F.lit(PLAN_AND_MOVEMENT).alias("kind"), F.lit(0).alias("_k"))
    before = _row_before(rows, (*key, "is_plan"), start, row_id, registration, split_by)
    lag = before.select("*", F.col("_before.id").alias("partner_id"), F.col("_before.reg").alias("_reg"), minutes_between(F.col(start), F.col("_before.start")).alias("gap_min"))
    lag = lag.where((F.col("gap_min") <= near_min) & compatible(F.col(registration), F.col("_reg")))
    kind = F.when(F.col("is_plan"), REPEATED_PLAN).otherwise(REPEATED_MOVEMENT)
    repeats = lag.select(F.col(row_id).alias("row_id"), "partner_id", "gap_min", kind.alias("kind"), F.when(F.col("is_plan"), 1).otherwise(2).alias("_k"))
    both = first.unionByName(repeats)
    return both.groupBy("row_id", "partner_id").agg(F.min_by(F.struct("gap_min", "kind"), "_k").alias("_b")).select("row_id", "partner_id", "_b.*")


def _row_before(rows: DataFrame, key: tuple[str, ...], start: str, row_id: str, registration: str, split_by: str | None) -> DataFrame:
    """Adds _before: start, id and registration of the row before in its key; with ``split_by`` windows end with a part, and what stands last in the parts before is carried in."""
    row = F.struct(F.col(start).alias("start"), F.col(row_id).alias("id"), F.col(registration).alias("reg"))
    if not split_by:
        return rows.withColumn("_before", F.lag(row).over(Window.partitionBy(*key).orderBy(start, row_id)))
    parts = rows.withColumn("_part", F.date_trunc(split_by, start))
    names = [*key, "_part"]
    last = parts.groupBy(*names).agg(F.max_by(row, F.struct(start, row_id)).alias("_last"))
    carried = last.withColumn("_carried", F.lag("_last").over(Window.partitionBy(*key).orderBy("_part")))  # a row a part
    carried = carried.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(names)], "_carried")
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(names)])
    out = parts.withColumn("_before", F.lag(row).over(Window.partitionBy(*names).orderBy(start, row_id))).join(carried, same)
    return out.withColumn("_before", F.coalesce("_before", "_carried")).drop("_part", "_carried", *[f"_k{i}" for i in range(len(names))])


def flagged(pairs: DataFrame) -> DataFrame:
    """Rows that repeat another."""
    return pairs.select("row_id").distinct()


def pair_groups(pairs: DataFrame) -> DataFrame:
    """row_id, group: connected components of the pairs."""
    return connected_components(pairs, "row_id", "partner_id").toDF("row_id", "group")


def merge_near(df: DataFrame, pairs: DataFrame, spec: MergeSpec, row_id: str) -> DataFrame:
    """Rows of one group of pairs merged as islands are; all others come through alone."""
    s, e = F.col(spec.start), F.col(spec.end)
    groups = pair_groups(pairs).withColumnRenamed("row_id", row_id)
    marked = df.join(groups, row_id, "left").withColumns({"island": F.coalesce("group", row_id), "_s": s, "_e": F.greatest(s, F.coalesce(e, s))})
    return merged(df, spec, marked.drop("group"))


def listing(df: DataFrame, pairs: DataFrame, row_id: str, columns: tuple[str, ...]) -> DataFrame:
    """Both rows of each pair, with pair (the repeat's id), role, kind and gap."""
    rows = df.select(F.col(row_id).alias("_id"), *columns)
    side = lambda c, role: pairs.join(rows, F.col(c) == F.col("_id")).select(F.col("row_id").alias("pair"), F.lit(role).alias("role"), F.col("_id").alias("id"), "kind", "gap_min", *columns)
    return side("row_id", "repeat").unionByName(side("partner_id", "original"))


def without_plans(df: DataFrame, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """(rows that are no plans, how many are): a plan has no counterpart among movements, so a comparison of those leaves it out and says so."""
    marked = with_plan_flag(df, start, end)
    return marked.where("not is_plan").drop("is_plan"), marked.agg(count_if(F.col("is_plan")).alias("n_plans"))


def duplicate_summary(df: DataFrame, pairs: DataFrame, by: tuple[str, ...], key: str, row_id: str, start: str, end: str, registration: str, pooled: DataFrame | None = None) -> DataFrame:
    """Per group nine counts and their shares of the rows: what repeats, and what could not be tested.

    n_rows, same_key (rows beyond the first of their ``key``; a null is one),
    near (rows that ``near_pairs`` flags), near_plan (of those, plans beside
    movements) and near_repeat, no_registration, plan_rows, no_time (neither
    stamp has a time of day) and untestable. With ``pooled`` (the parts before
    they were merged) same_key_parts counts repeats there. suspicious: over
    90 % have no time, which is a fault of reading rather than of the data.
    """
    kinds = pairs.groupBy(F.col("row_id").alias("_pair")).agg(F.max(F.when(F.col("kind") == PLAN_AND_MOVEMENT, 1).otherwise(0)).alias("_plan"))
    rows = df.join(kinds, F.col(row_id) == F.col("_pair"), "left")
    timeless = lambda c: F.col(c).isNull() | is_midnight(F.col(c))
    near, no_time = F.col("_pair").isNotNull(), timeless(start) & timeless(end)
    counts = rows.groupBy(*by).agg(
        F.count("*").alias("n_rows"), count_if(near).alias("near"), count_if(near & (F.col("_plan") == 1)).alias("near_plan"), count_if(near & (F.col("_plan") == 0)).alias("near_repeat"),
        count_if(F.coalesce(F.trim(registration), F.lit("")) == "").alias("no_registration"), count_if(F.coalesce(F.col(start) == F.col(end), F.lit(False))).alias("plan_rows"),
        count_if(no_time).alias("no_time"), count_if(no_time).alias("untestable"),
    )
    out = counts.join(surplus(df, by, (key,)).select(*by, F.col("n_surplus").alias("same_key")), list(by))
    if pooled is not None:
        out = out.join(surplus(pooled, by, (key,)).select(*by, F.col("n_surplus").alias("same_key_parts")), list(by), "left")
    pct = lambda c, digits: F.round(100.0 * F.col(c) / F.col("n_rows"), digits)
    return out.withColumns({
        "pct_near": pct("near", 3), "pct_no_registration": pct("no_registration", 1), "pct_plan": pct("plan_rows", 1), "pct_no_time": pct("no_time", 1),
        "pct_tested": F.round(100.0 * (1 - F.col("untestable") / F.col("n_rows")), 1), "suspicious": F.col("no_time") / F.col("n_rows") > 0.9,
    })


def examples(df: DataFrame, pairs: DataFrame, key: tuple[str, ...], row_id: str, start: str, groups: int = 5) -> DataFrame:
    """All rows of the first ``groups`` keys (in their order) that hold a pair, with flagged and the gap to the row before: a report."""
    marked = df.join(flagged(pairs).select(F.col("row_id").alias(row_id), F.lit(True).alias("flagged")), row_id, "left")
    some = marked.where("flagged").select(*key).distinct().orderBy(*key).limit(groups)
    by = Window.partitionBy(*key).orderBy(start, row_id)
    return marked.join(some, list(key), "left_semi").withColumns({"flagged": F.coalesce("flagged", F.lit(False)), "gap_min": minutes_between(F.col(start), F.lag(start).over(by))})


def before_and_after(before: DataFrame, after: DataFrame, predicate, columns: tuple[str, ...]) -> DataFrame:
    """The rows that a predicate picks, as they were and as they were merged: stage and columns."""
    tag = lambda df, s: df.where(predicate).select(F.lit(s).alias("stage"), *columns)
    return tag(before, "before").unionByName(tag(after, "after"))
