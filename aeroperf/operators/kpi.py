"""Percentile-reference KPI: duration, validity gate, grouped exact percentile, additional time by day, roll-ups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroperf.config import KpiSpec
from aeroperf.functions.numbers import count_if, lookup, share, total
from aeroperf.operators.components import cut_lineage


def is_valid(spec: KpiSpec) -> Column:
    """0 < duration <= cap; null is not valid. A value without a cap of its own is not valid either."""
    d = F.col(spec.duration)
    cap = lookup(F.col(spec.cap_by[0]), spec.cap_by[1]) if spec.cap_by else F.lit(spec.cap)
    return F.coalesce((d > 0) & (d <= cap), F.lit(False)) if spec.cap_by or spec.cap is not None else F.coalesce(d > 0, F.lit(False))


def in_window(spec: KpiSpec) -> Column:
    """Within the reference window, both ends included."""
    return F.col(spec.window_col).between(*[F.lit(x).cast("timestamp") for x in spec.window]) if spec.window else F.lit(True)


def reference(df: DataFrame, spec: KpiSpec, keep_small: bool = False) -> DataFrame:
    """key, n, reference: the exact percentile (linear interpolation) of valid durations of the window.

    Rows with a null in the key take no part. Groups below ``min_n`` are left
    out, or with ``keep_small`` get a null reference.
    """
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in spec.key])
    out = df.where(is_valid(spec) & whole & in_window(spec)).groupBy(*spec.key).agg(F.count("*").alias("n"), F.percentile(spec.duration, spec.p).alias("reference"))
    enough = F.col("n") >= spec.min_n
    return out.withColumn("reference", F.when(enough, F.col("reference"))) if keep_small else out.where(enough)


def with_reference(df: DataFrame, ref: DataFrame, spec: KpiSpec) -> DataFrame:
    """Adds reference (null where a row's key has none), valid (duration valid and reference known) and over_reference (the additional time).

    The table of references is as small as the number of key groups; Spark
    broadcasts it when its measured size allows that.
    """
    out = df.join(ref.select(*spec.key, "reference"), list(spec.key), "left")
    out = out.withColumn("valid", is_valid(spec) & F.col("reference").isNotNull())
    return out.withColumn("over_reference", F.when(F.col("valid"), F.col(spec.duration) - F.col("reference")))


def daily(df: DataFrame, spec: KpiSpec, by: tuple[str, ...]) -> DataFrame:
    """MVTS_VALID, MVTS_NA, TOT, TOT_REF, TOT_ADD and the sums of supplied columns, for each group of ``by``.

    Rows without a valid duration or a reference count in MVTS_NA and add 0. A
    null in ``by`` is a group. Supplied columns are summed over all rows.
    """
    v, d = F.col("valid"), F.col(spec.duration)
    return df.groupBy(*by).agg(
        count_if(v).alias("MVTS_VALID"), count_if(~v).alias("MVTS_NA"), total(d, v).alias("TOT"), total(F.col("reference"), v).alias("TOT_REF"),
        total(F.col("over_reference")).alias("TOT_ADD"), *[total(F.col(c)).alias(f"TOT_{c}") for c in spec.supplied],
    )


def percentile_kpi(df: DataFrame, spec: KpiSpec, by: tuple[str, ...]) -> DataFrame:
    """The whole of it: reference, join back, sums."""
    return daily(with_reference(df, reference(df, spec), spec), spec, by)


def rolled_up(sums: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Sums of a daily table at a coarser grain, with MVTS_TOTAL."""
    columns = [c for c in sums.columns if c.startswith(("MVTS_", "TOT"))]
    return sums.groupBy(*by).agg(*[F.sum(c).alias(c) for c in columns]).withColumn("MVTS_TOTAL", F.col("MVTS_VALID") + F.col("MVTS_NA"))


def null_audit(df: DataFrame, by: tuple[str, ...], columns: tuple[str, ...], valid: Column) -> DataFrame:
    """N_TOTAL, N_VALID, PCT_VALID, and N_MISSING_ of each column."""
    out = df.groupBy(*by).agg(F.count("*").alias("N_TOTAL"), count_if(valid).alias("N_VALID"), *[count_if(F.col(c).isNull()).alias(f"N_MISSING_{c}") for c in columns])
    return out.withColumn("PCT_VALID", share(F.col("N_VALID"), F.col("N_TOTAL"), 2))


def reference_coverage(ref: DataFrame, by: tuple[str, ...], min_n: int) -> DataFrame:
    """How many groups there are and how many hold enough samples; ``ref`` from ``reference(keep_small=True)``."""
    return ref.groupBy(*by).agg(F.count("*").alias("N_REFERENCE_GROUPS"), count_if(F.col("n") >= min_n).alias("N_VALID_REFERENCE_GROUPS"))


def ratio_grains(sums: DataFrame, grains: list[tuple[str, ...]], ratios: dict[str, tuple[str, str]], digits: int = 4) -> DataFrame:
    """Ratios of sums at several grains in one pass (grouping sets); ``grain`` is the bit mask of the columns summed over."""
    columns = list(dict.fromkeys(c for g in grains for c in g))
    need = sorted({c for pair in ratios.values() for c in pair})
    sets = [[F.col(c) for c in g] for g in grains]
    out = sums.groupingSets(sets, *[F.col(c) for c in columns]).agg(F.grouping_id().alias("grain"), *[F.sum(c).alias(c) for c in need])
    return out.select(*columns, F.col("grain").cast("long").alias("grain"), *[share(F.col(a), F.col(b), digits, percent=False).alias(n) for n, (a, b) in ratios.items()])


def comparability(df: DataFrame, by: tuple[str, ...], level: str, base_level, value: str, tolerance: float) -> DataFrame:
    """Medians of ``value`` by group and level, and whether each lies within ``tolerance`` of the base level's.

    A group without the base level has a null difference and is not comparable.
    """
    med = with_median(df.groupBy(*by, level).agg(F.count("*").alias("n")), df, (*by, level), value, "median")
    base = med.where(F.col(level) == base_level).select(*by, F.col("median").alias("base_median"))
    out = med.join(base, list(by), "left").withColumn("difference", F.col("median") - F.col("base_median"))
    return out.withColumn("comparable", F.coalesce(F.abs("difference") <= tolerance, F.lit(False)))


def percentiles(df: DataFrame, by: tuple[str, ...], value: str, ps: tuple[float, ...]) -> DataFrame:
    """Exact percentiles with linear interpolation, one column p<percent> each. A null in ``by`` is a group; null values don't count.

    ``F.percentile`` holds a group's distinct values in one buffer, which suits
    minutes. Here a group may be the whole table and its values all different:
    values are counted, sorted by range over all tasks, and the running count of
    a value (its task's, and the sum of the tasks before) tells whether it is one
    of the at most two order statistics that a percentile lies between.
    """
    v = F.col(value).cast("double")
    counts = df.where(v.isNotNull()).groupBy(*by, v.alias("_v")).agg(F.count("*").alias("_n"))
    dealt = cut_lineage(counts.repartitionByRange(*by, "_v").withColumn("_part", F.spark_partition_id()))
    parts = dealt.groupBy(*by, "_part").agg(F.sum("_n").alias("_sum"))
    group = Window.partitionBy(*by)
    parts = parts.withColumns({"_before": F.coalesce(F.sum("_sum").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_all": F.sum("_sum").over(group)})
    names = [*by, "_part"]
    ahead = parts.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(names)], "_before", "_all")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r{i}")) for i, c in enumerate(names)])
    inside = F.sum("_n").over(Window.partitionBy(*names).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = dealt.withColumn("_in", inside).join(ahead, same).withColumn("_to", F.col("_before") + F.col("_in"))  # places _to - _n to _to - 1
    place = [F.lit(float(p)) * (F.col("_all") - 1) for p in ps]
    holds = lambda x: (x >= F.col("_to") - F.col("_n")) & (x < F.col("_to"))
    ends = [(F.floor(x), F.ceil(x)) for x in place]
    wanted = reduce(lambda a, b: a | b, [holds(x) for pair in ends for x in pair])
    aggs = [F.max(F.when(holds(x), F.col("_v"))).alias(f"_{i}{side}") for i, pair in enumerate(ends) for side, x in zip("lh", pair)]
    got = placed.where(wanted).groupBy(*by).agg(*aggs, F.max("_all").alias("_all"))
    between = lambda i, x: F.col(f"_{i}l") + (F.col(f"_{i}h") - F.col(f"_{i}l")) * (x - F.floor(x))
    return got.select(*by, *[between(i, x).alias(f"p{round(100 * p):02d}") for i, (p, x) in enumerate(zip(ps, place))])


def with_median(groups: DataFrame, df: DataFrame, by: tuple[str, ...], value: str, name: str) -> DataFrame:
    """``groups`` (one row a group) with the median of ``value`` over ``df``'s rows of the group, as ``percentiles`` finds it; null where there is none."""
    median = percentiles(df, by, value, (0.5,))
    median = median.select(*[F.col(k).alias(f"_m{i}") for i, k in enumerate(by)], F.col("p50").alias(name))
    if not by:
        return groups.join(median, F.lit(True), "left")  # one row each
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_m{i}")) for i, k in enumerate(by)])
    return groups.join(median, same, "left").drop(*[f"_m{i}" for i in range(len(by))])
