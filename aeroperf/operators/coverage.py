"""What is held and what is missing: days, months, years, stamps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroperf.functions.numbers import clamp, count_if, share
from aeroperf.functions.time import days_in_month, is_midnight, minutes_between, month_text, on_the_hour, shifted
from aeroperf.operators.kpi import with_median


def day_counts(df: DataFrame, ts: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows per day; rows without a stamp are left out."""
    return df.where(F.col(ts).isNotNull()).groupBy(*by, F.to_date(ts).alias("day")).agg(F.count("*").alias("n"))


def calendar(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per day of a closed range."""
    return df.sparkSession.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}', INTERVAL 1 DAY)) AS day")


def missing_days(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Days of a closed range without a row."""
    held = df.where(F.col(ts).isNotNull()).select(F.to_date(ts).alias("day")).distinct()
    return calendar(df, start, end).join(held, "day", "left_anti")


def month_coverage(df: DataFrame, ts: str, complete: int = 28, partial: int = 20, slack: int = 1) -> DataFrame:
    """month, n, days held, days it has, enough (all but ``slack`` days) and status: complete, partial or truncated."""
    days = day_counts(df, ts)
    out = days.groupBy(month_text(F.col("day")).alias("month")).agg(F.sum("n").alias("n"), F.count("*").alias("days"), F.max(days_in_month(F.col("day"))).alias("possible"))
    status = F.when(F.col("days") >= complete, "complete").when(F.col("days") >= partial, "partial").otherwise("truncated")
    return out.withColumns({"possible": F.col("possible").cast("long"), "enough": F.col("days") >= F.col("possible") - slack, "status": status})


def year_coverage(df: DataFrame, ts: str, years: tuple[int, ...], as_of: str, tolerance: int = 1) -> DataFrame:
    """For each year: n, days held, days possible up to ``as_of``, missing, and whether it counts as complete."""
    spine = df.sparkSession.createDataFrame([(y,) for y in years], "year int")
    held = day_counts(df, ts).groupBy(F.year("day").alias("year")).agg(F.sum("n").alias("n"), F.count("*").alias("days"))
    first, last = F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))
    possible = clamp(F.datediff(F.least(last, F.lit(as_of).cast("date")), first) + 1, 0, 366).cast("long")
    out = spine.join(held, "year", "left").select("year", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("days", F.lit(0)).alias("days"), possible.alias("possible"))
    out = out.withColumn("missing", F.greatest(F.col("possible") - F.col("days"), F.lit(0).cast("long")))
    return out.withColumn("complete", (F.col("possible") > 0) & (F.col("missing") <= tolerance))


def edge_days(df: DataFrame, ts: str, below: float = 0.5) -> DataFrame:
    """The first and last day held of each year, against the mean of the year's days: edge, day, n, mean, partial."""
    days = day_counts(df, ts).withColumn("year", F.year("day"))
    year = days.groupBy("year").agg(F.min("day").alias("first"), F.max("day").alias("last"), F.avg("n").alias("mean"))
    out = days.join(year, "year").where("day = first or day = last")
    edge = F.explode(F.filter(F.array(F.when(F.col("day") == F.col("first"), "first"), F.when(F.col("day") == F.col("last"), "last")), lambda x: x.isNotNull()))
    return out.select("year", edge.alias("edge"), "day", "n", "mean").withColumn("partial", F.col("n") < F.col("mean") * below)


def boundary_rows(df: DataFrame, ts: str, bound: str, hours: float) -> DataFrame:
    """Rows within ``hours`` of a bound, either side (half-open); the filter is on the stamp itself and is pushed down."""
    at = F.lit(bound).cast("timestamp")
    return df.where((F.col(ts).cast("timestamp") >= shifted(at, -60 * hours)) & (F.col(ts).cast("timestamp") < shifted(at, 60 * hours)))


def partial_years(df: DataFrame, day_text: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Years whose last day (ISO text) comes before 31 December: year, last_day."""
    out = df.groupBy(*by, F.substring(day_text, 1, 4).alias("year")).agg(F.max(F.substring(day_text, 1, 10)).alias("last_day"))
    return out.where(F.col("last_day") < F.concat("year", F.lit("-12-31")))


def years_by_definition(df: DataFrame, stamps: dict[str, str], offsets_h: dict[str, float]) -> DataFrame:
    """Rows per year under every pair of stamp and clock offset: definition, clock, year, n."""
    parts = F.array(*[F.struct(F.lit(n).alias("definition"), F.lit(o).alias("clock"), F.year(shifted(F.col(c), 60 * h)).alias("year")) for n, c in stamps.items() for o, h in offsets_h.items()])
    return df.select(F.explode(parts).alias("_d")).select("_d.*").where("year is not null").groupBy("definition", "clock", "year").agg(F.count("*").alias("n"))


def clock_shares(df: DataFrame, stamps: tuple[str, ...], by: tuple[Column, ...] = ()) -> DataFrame:
    """For each stamp column: n, nulls, and the shares at midnight and on the hour among those there (percent)."""
    parts = F.array(*[F.struct(F.lit(c).alias("stamp"), F.col(c).cast("timestamp").alias("t")) for c in stamps])
    out = df.select(*by, F.explode(parts).alias("_s")).select("*", "_s.*").drop("_s")
    keys = [c for c in out.columns if c != "t"]
    out = out.groupBy(*keys).agg(F.count("*").alias("n"), count_if(F.col("t").isNull()).alias("n_null"), count_if(is_midnight(F.col("t"))).alias("n_midnight"), count_if(on_the_hour(F.col("t"))).alias("n_hour"))
    there = F.col("n") - F.col("n_null")
    return out.withColumns({"pct_midnight": share(F.col("n_midnight"), there, 4), "pct_hour": share(F.col("n_hour"), there, 4)})


def stamp_agreement(df: DataFrame, a: str, b: str, by: tuple[str, ...] = ()) -> DataFrame:
    """How often two stamps are equal, and the median and largest absolute difference (minutes) of those that are not."""
    d = F.abs(minutes_between(F.col(a), F.col(b)))
    rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).withColumn("_d", d)
    apart = F.when(F.col("_d") > 0, F.col("_d"))
    out = rows.groupBy(*by).agg(F.count("*").alias("n"), count_if(F.col("_d") == 0).alias("n_equal"), F.max(apart).alias("max_diff"))
    out = with_median(out, rows.withColumn("_apart", apart), by, "_apart", "median_diff")
    return out.withColumn("pct_equal", share(F.col("n_equal"), F.col("n"), 4))


def estimate_check(df: DataFrame, estimate: str, actual: str, low: float, high: float, by: tuple[str, ...] = ()) -> DataFrame:
    """Estimated against actual stamps: share at midnight (no time known), median difference, shares plausible (low..high minutes) and negative."""
    d = minutes_between(F.col(estimate), F.col(actual))
    timed = ~is_midnight(F.col(estimate).cast("timestamp"))
    rows = df.where(F.col(estimate).isNotNull() & F.col(actual).isNotNull()).withColumns({"_d": d, "_t": timed})
    known = F.when(F.col("_t"), F.col("_d"))
    out = rows.groupBy(*by).agg(F.count("*").alias("n"), count_if(~F.col("_t")).alias("n_timeless"), count_if(known.between(low, high)).alias("n_plausible"), count_if(known < 0).alias("n_negative"))
    out = with_median(out, rows.withColumn("_known", known), by, "_known", "median_diff")
    timed_n = F.col("n") - F.col("n_timeless")
    return out.withColumns({"pct_timeless": share(F.col("n_timeless"), F.col("n"), 4), "pct_plausible": share(F.col("n_plausible"), timed_n, 4), "pct_negative": share(F.col("n_negative"), timed_n, 4)})


def source_overlap(left: DataFrame, right: DataFrame, by: tuple[str, ...], key: str) -> DataFrame:
    """Per group: distinct keys of either side, shared ones, and those of one side alone."""
    side = lambda df, name: df.where(F.col(key).isNotNull()).select(*by, F.upper(F.col(key).cast("string")).alias("_k")).distinct().withColumn(name, F.lit(1))
    both = side(left, "_l").join(side(right, "_r"), [*by, "_k"], "full_outer")
    l, r = F.col("_l").isNotNull(), F.col("_r").isNotNull()
    return both.groupBy(*by).agg(count_if(l).alias("n_left"), count_if(r).alias("n_right"), count_if(l & r).alias("shared"), count_if(l & ~r).alias("only_left"), count_if(r & ~l).alias("only_right"))


def populated(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row per column: field, n, filled (neither null nor blank), pct_filled; one pass."""
    text = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    once = df.agg(F.count("*").alias("n"), *[F.count(text(c)).alias(f"_{i}") for i, c in enumerate(columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_{i}").alias("filled")) for i, c in enumerate(columns)]))
    return once.select("n", rows.alias("_r")).select("_r.field", "n", "_r.filled").withColumn("pct_filled", share(F.col("filled"), F.col("n"), 4))


def share_of_total(df: DataFrame, value: str, by: tuple[str, ...] = (), digits: int = 4) -> DataFrame:
    """Adds each row's share of its group's total, in percent. A null in ``by`` is a group. Totals are summed and joined, so that no group, nor the whole, meets in one task."""
    totals = df.groupBy(*by).agg(F.sum(value).alias("_total"))
    if not by:
        return df.crossJoin(totals).withColumn("pct", share(F.col(value), F.col("_total"), digits)).drop("_total")  # one row
    totals = totals.withColumnsRenamed({k: f"_by{i}" for i, k in enumerate(by)})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_by{i}")) for i, k in enumerate(by)])
    return df.join(totals, same).withColumn("pct", share(F.col(value), F.col("_total"), digits)).drop("_total", *[f"_by{i}" for i in range(len(by))])


def absent_fields(df: DataFrame, expected: tuple[str, ...]) -> list[str]:
    """Expected columns that a table lacks, whatever their case or underscores."""
    from aeroperf.functions.text import flat_name

    held = {flat_name(c) for c in df.columns}
    return [c for c in expected if flat_name(c) not in held]


def count_by(sources: dict[str, DataFrame], ts: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """Rows per source, year and the columns that a source has (null where it lacks one); a source without ``ts`` is left out."""
    parts = []
    for name, df in sources.items():
        if ts in df.columns:
            own = [F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
            parts.append(df.select(F.lit(name).alias("source"), F.year(ts).alias("year"), *own))
    if not parts:
        raise ValueError(f"no source has {ts}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("source", "year", *columns).agg(F.count("*").alias("n"))
