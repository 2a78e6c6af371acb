"""Two versions of one dataset: keys of one side, fields that differ, offsets, verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroperf.functions.numbers import count_if, share
from aeroperf.functions.time import minutes_between
from aeroperf.operators.kpi import percentiles, with_median


def _null_safe(left: DataFrame, right: DataFrame, key: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in key])


def only_left(left: DataFrame, right: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows whose key the other side lacks; a null matches a null."""
    return left.join(right.select(*key).distinct(), _null_safe(left, right, key), "left_anti")


def shared(left: DataFrame, right: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows whose key the other side has too; a null matches a null."""
    return left.join(right.select(*key).distinct(), _null_safe(left, right, key), "left_semi")


def keyed_diff(left: DataFrame, right: DataFrame, key: tuple[str, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """Per group: distinct keys of the left and the right, in both, and of one side alone. A null in the key is a value.

    Both sides are tagged and aggregated by key: one shuffle, no join.
    """
    tag = lambda df, l, r: df.select(*dict.fromkeys([*by, *key]), F.lit(l).alias("_l"), F.lit(r).alias("_r"))
    keys = tag(left, 1, 0).unionByName(tag(right, 0, 1)).groupBy(*dict.fromkeys([*by, *key])).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    l, r = F.col("_l") == 1, F.col("_r") == 1
    return keys.groupBy(*by).agg(count_if(l).alias("n_left"), count_if(r).alias("n_right"), count_if(l & r).alias("n_both"), count_if(l & ~r).alias("only_left"), count_if(r & ~l).alias("only_right"))


def paired(left: DataFrame, right: DataFrame, key: tuple[str, ...], fields: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """key, and each field as <field>_l and <field>_r: the first row in ``order`` of each key on either side, joined. Null keys don't pair."""

    def first(df: DataFrame, tag: str) -> DataFrame:
        best = F.min_by(F.struct(*[F.col(f).alias(f"{f}_{tag}") for f in fields]), F.struct(*[F.col(c) for c in order]))
        return df.groupBy(*key).agg(best.alias("_b")).select(*key, "_b.*")

    return first(left, "l").join(first(right, "r"), list(key))


def field_disagreement(pairs: DataFrame, fields: tuple[str, ...], null_is_difference: bool = True, digits: int = 4) -> DataFrame:
    """One row per field: n, pct_different, pct_only_left, pct_only_right; one pass over ``paired`` rows.

    With ``null_is_difference`` a value against a null differs; otherwise only
    two values that differ do. Values of one side alone are counted apart.
    """
    l, r = (lambda f: F.col(f"{f}_l")), (lambda f: F.col(f"{f}_r"))
    differs = (lambda f: ~l(f).eqNullSafe(r(f))) if null_is_difference else (lambda f: F.coalesce(l(f) != r(f), F.lit(False)))
    once = pairs.agg(F.count("*").alias("n"), *[x for f in fields for x in (count_if(differs(f)).alias(f"{f}_d"), count_if(l(f).isNotNull() & r(f).isNull()).alias(f"{f}_ol"), count_if(r(f).isNotNull() & l(f).isNull()).alias(f"{f}_or"))])
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_d").alias("d"), F.col(f"{f}_ol").alias("ol"), F.col(f"{f}_or").alias("or_")) for f in fields]))
    out = once.select("n", rows.alias("_f")).select("n", "_f.*")
    return out.select("field", "n", share(F.col("d"), F.col("n"), digits).alias("pct_different"), share(F.col("ol"), F.col("n"), digits).alias("pct_only_left"), share(F.col("or_"), F.col("n"), digits).alias("pct_only_right"))


def value_pairs(pairs: DataFrame, field: str) -> DataFrame:
    """Contingency of a field's values on both sides, nulls included."""
    return pairs.groupBy(F.col(f"{field}_l").alias("left_value"), F.col(f"{field}_r").alias("right_value")).agg(F.count("*").alias("n"))


def missing_values(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Values that one side alone has, with their counts there: value, side, n."""
    tag = lambda df, side: df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).withColumn("side", F.lit(side))
    both = tag(left, "left").unionByName(tag(right, "right"))
    return both.groupBy("value").agg(F.count("*").alias("_s"), F.max("side").alias("side"), F.max("n").alias("n")).where("_s = 1").select("value", "side", "n")


def overlap_share(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """One row: distinct values of either side, shared ones, and their share of the left in percent."""
    d = keyed_diff(left.where(F.col(column).isNotNull()), right.where(F.col(column).isNotNull()), (column,))
    return d.select("n_left", "n_right", F.col("n_both").alias("shared"), share(F.col("n_both"), F.col("n_left"), 4).alias("pct_left"))


def key_shape(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """One row: lengths, whether all match a pattern, and how many are null."""
    return df.agg(F.min(F.length(column)).cast("long").alias("min_length"), F.max(F.length(column)).cast("long").alias("max_length"), F.bool_and(F.col(column).rlike(pattern)).alias("all_match"), count_if(F.col(column).isNull()).alias("n_null"))


def gap_profile(df: DataFrame, start: str, end: str, by: tuple[Column, ...]) -> DataFrame:
    """Counts and shares of rows by group, with how many have no span: what unmatched rows look like."""
    out = df.groupBy(*by).agg(F.count("*").alias("n"), count_if(F.coalesce(F.col(start) == F.col(end), F.lit(False))).alias("n_no_span"))
    return out.withColumn("pct_no_span", share(F.col("n_no_span"), F.col("n"), 4))


def time_shift(pairs: DataFrame, left_time: str, right_time: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Per group: n, median and the most frequent rounded offset (right minus left, minutes; ties to the smaller) with its share."""
    d = pairs.withColumn("_d", minutes_between(F.col(right_time), F.col(left_time))).where("_d is not null").withColumn("_o", F.round("_d"))
    medians = with_median(d.groupBy(*by).agg(F.count("*").alias("n")), d, by, "_d", "median")
    counts = d.groupBy(*by, "_o").agg(F.count("*").alias("_n"))
    modes = counts.groupBy(*by).agg(F.max_by("_o", F.struct(F.col("_n"), -F.col("_o"))).alias("mode"), F.max("_n").alias("n_mode"))
    out = medians.join(modes, list(by)) if by else medians.crossJoin(modes)  # one row each
    return out.withColumn("pct_mode", share(F.col("n_mode"), F.col("n"), 4))


def step_test(monthly: DataFrame, month: str = "month", mode: str = "mode", step: float = 60.0) -> DataFrame:
    """Adds the change of the modal offset to the month before and whether it is a clock step (a whole hour): the daylight-saving test."""
    from pyspark.sql import Window

    change = F.col(mode) - F.lag(mode).over(Window.orderBy(month))  # one row a month
    return monthly.withColumn("change", change).withColumn("is_step", F.coalesce((F.abs("change") >= step) & (F.abs("change") % step == 0), F.lit(False)))


def window_shape(df: DataFrame, start: str, end: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Quartiles and 99th percentile of spans in minutes, and the share of rows without one."""
    d = df.withColumn("_d", minutes_between(F.col(end), F.col(start)))
    out = d.groupBy(*by).agg(F.count("_d").alias("n"), count_if(F.col("_d") == 0).alias("n_zero"))
    places = percentiles(d, by, "_d", (0.25, 0.5, 0.75, 0.99))
    same = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"p.{k}")) for k in by], F.lit(True))
    both = out.alias("o").join(places.alias("p"), same, "left")  # a row a group
    return both.select(*[F.col(f"o.{k}") for k in by], "n", "n_zero", share(F.col("n_zero"), F.col("n"), 4).alias("pct_zero"), "p25", "p50", "p75", "p99")


def validate(golden: DataFrame, ours: DataFrame, key: tuple[str, ...], values: tuple[str, ...], tolerance: float = 1e-6) -> DataFrame:
    """One row per value column: groups compared, equal, different, largest difference, both sums, their deviation, and a verdict.

    Keys are matched null-safely. PASS: all equal; WITHIN_TOLERANCE: sums deviate
    by at most 0.05 % and at least 99.9 % of groups are equal; else FAIL.
    """
    g = golden.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], *[F.col(v).alias(f"{v}_g") for v in values])
    cond = reduce(lambda a, b: a & b, [g[f"_k{i}"].eqNullSafe(ours[k]) for i, k in enumerate(key)])
    both = g.join(ours.select(*key, *values), cond)
    diff = lambda v: F.abs(F.col(f"{v}_g") - F.col(v))
    once = both.agg(F.count("*").alias("n"), *[x for v in values for x in (count_if(diff(v) <= tolerance).alias(f"{v}_e"), F.max(diff(v)).alias(f"{v}_m"), F.sum(f"{v}_g").cast("double").alias(f"{v}_sg"), F.sum(v).cast("double").alias(f"{v}_so"))])
    rows = F.explode(F.array(*[F.struct(F.lit(v).alias("field"), *[F.col(f"{v}_{x}").alias(n) for x, n in (("e", "equal"), ("m", "max_diff"), ("sg", "sum_golden"), ("so", "sum_ours"))]) for v in values]))
    out = once.select("n", rows.alias("_v")).select("_v.field", "n", "_v.equal", (F.col("n") - F.col("_v.equal")).alias("different"), "_v.max_diff", "_v.sum_golden", "_v.sum_ours")
    deviation, equal = F.abs(F.try_divide(100 * (F.col("sum_ours") - F.col("sum_golden")), F.col("sum_golden"))), F.try_divide(100.0 * F.col("equal"), F.col("n"))
    verdict = F.when(F.col("different") == 0, "PASS").when((deviation <= 0.05) & (equal >= 99.9), "WITHIN_TOLERANCE").otherwise("FAIL")
    return out.withColumns({"pct_deviation": deviation, "pct_equal": equal, "verdict": verdict})


def worst_offenders(golden: DataFrame, ours: DataFrame, key: tuple[str, ...], value: str, n: int = 10) -> DataFrame:
    """The groups with the largest differences, ties in order of the key: a report of ``n`` rows."""
    both = golden.select(*key, F.col(value).alias("golden")).join(ours.select(*key, F.col(value).alias("ours")), list(key))
    return both.withColumn("difference", F.abs(F.col("golden") - F.col("ours"))).orderBy(F.desc_nulls_last("difference"), *key).limit(n)


def score_windows(golden: DataFrame, candidates: dict[str, DataFrame], key: tuple[str, ...], values: tuple[str, ...], tolerance: float = 1e-6) -> DataFrame:
    """How well each candidate (a reference-window definition) reproduces a golden table: candidate, n, n_ok per value."""
    out = []
    for name, df in candidates.items():
        both = golden.join(df.select(*key, *[F.col(v).alias(f"{v}_o") for v in values]), list(key), "left")
        ok = [count_if(F.abs(F.col(v) - F.col(f"{v}_o")) < tolerance).alias(f"{v}_ok") for v in values]
        out.append(both.agg(F.lit(name).alias("candidate"), F.count("*").alias("n"), *ok))
    return reduce(DataFrame.unionByName, out)


def lookup_record(left: DataFrame, right: DataFrame, predicate: Column, columns: tuple[str, ...]) -> DataFrame:
    """The rows of both sides that a predicate picks, side by side in one table with their side's name."""
    tag = lambda df, s: df.where(predicate).select(F.lit(s).alias("side"), *columns)
    return tag(left, "left").unionByName(tag(right, "right"))


def key_variants(df: DataFrame, callsign: str, departure: str, arrival: str, day: str, planned: str, start: str, split: bool = False) -> DataFrame:
    """Adds the keys that versions of a flight are compared by: flight_day, eobt, eobt_day and eobt_seq (the rotation's number in its day). ``split`` as in ``numbered``: for rows whose key is mostly null."""
    from aeroperf.operators.dedup import numbered

    base = (callsign, departure, arrival, day)
    out = numbered(df, base, [F.col(planned).asc_nulls_last(), F.col(start).asc_nulls_last()], "_seq", split)
    route = F.concat_ws("|", callsign, departure, arrival)
    return out.withColumns({
        "flight_day": F.concat_ws("|", route, F.date_format(day, "yyyy-MM-dd")), "eobt": F.concat_ws("|", route, F.date_format(planned, "yyyy-MM-dd HH:mm:ss")),
        "eobt_day": F.concat_ws("|", route, F.date_format(planned, "yyyy-MM-dd")), "eobt_seq": F.concat_ws("|", route, F.date_format(day, "yyyy-MM-dd"), "_seq"),
    }).drop("_seq")


class Sides:
    """Two versions of a dataset, read once and kept for several comparisons; what they are kept by includes the columns."""

    def __init__(self, left, right):
        """``left`` and ``right`` are functions of a list of columns to a DataFrame."""
        self._read, self._held = (left, right), {}

    def get(self, columns: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
        if columns not in self._held:
            self._held[columns] = tuple(f(list(columns)).persist() for f in self._read)
        return self._held[columns]

    def release(self) -> None:
        for pair in self._held.values():
            for df in pair:
                df.unpersist()
        self._held.clear()
