"""Gaps and islands on a running end, and the lossless merge of each island."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroperf.config import MergeSpec
from aeroperf.functions.text import clean, filled, first_filled
from aeroperf.functions.time import minutes_between
from aeroperf.operators.components import cut_lineage
from aeroperf.operators.kpi import percentiles
from aeroperf.operators.ordered import carried, filled_state, in_two_steps, joined_records, joined_state, placed_state, records_state, total, union_state


def _prepared(df: DataFrame, spec: MergeSpec) -> DataFrame:
    """Adds _s and _e: a null end is the start, an end before the start is moved to it."""
    s, e = F.col(spec.start), F.col(spec.end)
    return df.withColumns({"_s": s, "_e": F.greatest(s, F.coalesce(e, s))})


def _chained(spec: MergeSpec) -> Column:
    """Whether a row can be chained: it has a start and, unless nulls may group, a whole key."""
    ok = F.col(spec.start).isNotNull()
    return ok if spec.null_key == "group" else reduce(lambda a, k: a & F.col(k).isNotNull(), spec.key, ok)


def _order(spec: MergeSpec) -> list[Column]:
    return [F.col("_s").asc(), *[F.col(c).asc_nulls_first() for c in spec.order]]


def chain(df: DataFrame, spec: MergeSpec, gap: Column | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """Adds island (from 1 within the key): a row opens one when it starts more than the gap after the latest end so far.

    A gap of exactly ``gap_min`` joins. Rows without a start, or with a null in
    the key, have a null island. ``gap`` and ``also`` let the gap be a column
    that is part of the key. _s, _e and _lone are for what follows: a grouping
    by key, _lone and island needs no further shuffle.
    """
    keys = [*spec.key, *also]
    ok = _chained(spec)
    # rows that are not chained stand alone, so that null keys don't meet in one task
    lone = F.when(~ok, F.xxhash64(*[F.col(c) for c in spec.order]))
    out = _prepared(df, spec).withColumn("_lone", lone)
    limit = F.lit(spec.gap_min) if gap is None else gap
    new = (F.col("_before").isNull() | (minutes_between(F.col("_s"), F.col("_before")) > limit)).cast("int")
    if spec.split_by:
        return _chained_in_parts(out, [*keys, "_lone"], spec, ok, new)
    by = Window.partitionBy(*keys, "_lone").orderBy(*_order(spec))
    out = out.withColumn("_before", F.max("_e").over(by.rowsBetween(Window.unboundedPreceding, -1))).withColumn("_new", new)
    out = out.withColumn("island", F.when(ok, F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))))
    return out.drop("_before", "_new")


def _chained_in_parts(out: DataFrame, keys: list[str], spec: MergeSpec, ok: Column, new: Column) -> DataFrame:
    """The same islands with a key's rows cut by time: windows within a part, and a carry from the parts before."""
    out = out.withColumn("_part", F.date_trunc(spec.split_by, "_s"))
    by = Window.partitionBy(*keys, "_part").orderBy(*_order(spec))
    out = carried(out, keys, "_part", {"_reach": (F.col("_e"), F.max)})
    before = F.greatest(F.max("_e").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.col("_reach"))
    out = out.withColumn("_before", before).withColumn("_new", new)
    out = carried(out, keys, "_part", {"_opened": (F.col("_new"), F.sum)})
    within = F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))
    out = out.withColumn("island", F.when(ok, within + F.coalesce("_opened", F.lit(0))))
    return out.drop("_part", "_reach", "_before", "_new", "_opened")


def edges(df: DataFrame, spec: MergeSpec, row_id: str) -> DataFrame:
    """Edges between consecutive records of an island: row_id, partner_id, gap_min (negative where they overlap). With ``split_by``, a window ends with a part, and what stands last in the parts before is carried in."""
    out = chain(df, spec).where("island is not null")
    group = [*spec.key, "_lone", "island"]
    if spec.split_by:
        place = F.struct("_s", *spec.order, F.col(row_id).alias("_row"))
        out = carried(out.withColumn("_part", F.date_trunc(spec.split_by, "_s")), group, "_part", {"_last": (place, F.max), "_reach": (F.col("_e"), F.max)})
    by = Window.partitionBy(*group, *(["_part"] if spec.split_by else [])).orderBy(*_order(spec))
    before, held = F.lag(row_id).over(by), F.max("_e").over(by.rowsBetween(Window.unboundedPreceding, -1))
    if spec.split_by:
        before, held = F.coalesce(before, F.col("_last._row")), F.greatest(held, F.col("_reach"))
    out = out.withColumns({"partner_id": before, "gap_min": minutes_between(F.col("_s"), held)})
    return out.where("partner_id is not null").select(F.col(row_id).alias("row_id"), "partner_id", "gap_min")


def merge_order(spec: MergeSpec) -> Column:
    """Which record's values come first: one with the preferred column filled, one with a span, the earliest, then ``order``."""
    blank = clean(F.col(spec.prefer_filled).cast("string")).isNull() if spec.prefer_filled else F.lit(False)
    return F.struct(blank, F.col("_s").eqNullSafe(F.col("_e")), F.col("_s"), *[F.col(c) for c in spec.order])


def merged(df: DataFrame, spec: MergeSpec, islands: DataFrame | None = None, places: bool = False) -> DataFrame:
    """One row per island: extremes of start and end, canonical unions, first filled values, N_MERGED, SPAN_MIN, ZERO_SPAN_ONLY, MERGED_IDS.

    Rows without an island come through alone. ZERO_SPAN_ONLY says that no
    record of the island had a span; it is null for single records. MERGED_IDS
    lists the identities in the merge's order; where a row was merged before
    (it has the columns N_MERGED and MERGED_IDS) counts are added up and the
    lists joined, so that merging again loses nothing and, alone, changes nothing.
    ``places`` adds what merging again needs to equal one merge of all records:
    where each first filled value (_at_ columns) and each record (_records) stands
    in the merge's order; rows without it stand, all together, where they would now.
    With ``split_by`` an island's records are dealt by their order to as many
    tasks as they need, and states of a bounded size are put together.
    """
    got = chain(df, spec) if islands is None else islands
    again = "N_MERGED" in df.columns
    placed = [f"_at_{c}" for c in spec.filled_cols] + (["_records"] if spec.identity else [])
    before = [c for c in placed if c in df.columns]
    held = places or bool(before)
    by = merge_order(spec)
    records = F.coalesce(F.sum("N_MERGED"), F.count("*")) if again else F.count("*")
    states = [total(spec.start, F.min("_s"), F.min), total(spec.end, F.max("_e"), F.max), *map(union_state, spec.union_cols)]
    zero = F.col("_s") == F.col("_e")
    zero = F.coalesce(F.col("ZERO_SPAN_ONLY"), zero) if again else zero
    states += [total("N_MERGED", records.cast("long")), total("_rows", F.count("*")), total("_zero", F.bool_and(zero), F.bool_and)]
    if again:
        states.append(total("_zero_before", F.min("ZERO_SPAN_ONLY"), F.min))
    name = F.col(spec.identity).cast("string") if spec.identity else None
    name = F.coalesce(F.col("MERGED_IDS"), name) if spec.identity and again else name
    if held:
        now = {f"_at_{c}": F.when(filled(F.col(c)), F.struct(by.alias("o"), F.col(c).alias("v"))) for c in spec.filled_cols}
        now |= {"_records": F.array(F.struct(by.alias("o"), name.alias("v")))} if spec.identity else {}
        now |= {c: F.coalesce(F.col(c), now[c]) for c in before}
        states += [records_state(c, x) if c == "_records" else placed_state(c, x) for c, x in now.items()]
    else:
        states += [filled_state(c, by) for c in spec.filled_cols]
        states += [joined_state("MERGED_IDS", name, by)] if spec.identity else []
    if "_lone" not in got.columns:
        got = got.withColumn("_lone", F.when(F.col("island").isNull(), F.xxhash64(*[F.col(c) for c in spec.order])))
    group = [*spec.key, "island", "_lone"]
    if spec.split_by:
        out = in_two_steps(got, group, [by], states)
    else:
        whole = {s.name: s.whole() for s in states} | ({} if held else {c: first_filled(F.col(c), by).alias(c) for c in spec.filled_cols})
        out = got.groupBy(*group).agg(*whole.values())
    if held:
        out = out.withColumns({c: F.col(f"_at_{c}.v") for c in spec.filled_cols})
        out = out.withColumn("MERGED_IDS", joined_records("_records")) if spec.identity else out
        out = out if places else out.drop(*placed)
    single = F.col("_rows") == 1
    zero = F.when(~single, F.col("_zero"))
    out = out.withColumn("ZERO_SPAN_ONLY", F.coalesce(zero, F.col("_zero_before")) if again else zero)
    out = out.withColumn("SPAN_MIN", minutes_between(F.col(spec.end), F.col(spec.start)))
    return out.drop("_rows", "_zero", "_zero_before", "_lone", "island")


def sweep(df: DataFrame, spec: MergeSpec, gaps: tuple[float, ...]) -> DataFrame:
    """Per gap: islands, records that were merged, the largest island and the 99th percentile of spans; one job for all gaps."""
    many = df.withColumn("gap_min", F.explode(F.array(*[F.lit(float(g)) for g in gaps])))
    got = chain(many, spec, F.col("gap_min"), ("gap_min",)).where("island is not null")
    per = got.groupBy("gap_min", *spec.key, "_lone", "island").agg(F.count("*").alias("n"), minutes_between(F.max("_e"), F.min("_s")).alias("span"))
    per = cut_lineage(per.select("gap_min", "n", "span"))
    sums = per.groupBy("gap_min").agg(F.count("*").alias("islands"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("merged_records"), F.max("n").alias("largest"))
    return sums.join(percentiles(per, ("gap_min",), "span", (0.99,)).withColumnRenamed("p99", "span_p99"), "gap_min")


def merge_parts(parts: list[DataFrame], spec: MergeSpec) -> DataFrame:
    """Parts that were merged on their own (months), merged again across their bounds; provenance is kept. Parts merged with ``places`` give what one merge of all their records gives."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged(whole, spec)
