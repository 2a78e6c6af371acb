"""Terminal airspace: one arrival and ring a row, additional transit against a reference by class, runway and sector."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroperf.config import MIN_SAMPLE, REFERENCE_P, REFERENCE_YEAR, RING_CAPS_MIN, RING_KEY, KpiSpec
from aeroperf.functions.numbers import ring_label, sector_group
from aeroperf.functions.text import clean, col_or_null
from aeroperf.functions.time import duration_minutes, minutes_between, parse_stamp
from aeroperf.operators import kpi
from aeroperf.operators.dedup import keep_one
from aeroperf.operators.reshape import lengthened, widened

RINGS = ("C40", "C100")
RING_VALUES = ("CROSS_TIME", "BEARING", "SECTOR", "SECTOR_GROUP", "TRANSIT", "UNIMPEDED", "ADDITIONAL")
IDS = ("ID", "FLTID", "ADEP", "ICAO", "REG", "TYPE", "CLASS", "RWY", "STND", "ALDT", "AIBT", "SIBT", "PHASE", "DATE", "YEAR")
BY = ("ICAO", "PHASE", "DATE", "RANGE", "CLASS", "RWY", "SECTOR_GROUP")


def spec(year: int = REFERENCE_YEAR) -> KpiSpec:
    return KpiSpec(RING_KEY, "TRANSIT", "DATE", cap_by=("RANGE", RING_CAPS_MIN), p=REFERENCE_P, min_n=MIN_SAMPLE, window_col="ALDT", window=(f"{year}-01-01 00:00:00", f"{year}-12-31 23:59:59"), supplied=("UNIMPEDED", "ADDITIONAL"))


def harmonised(raw: DataFrame) -> DataFrame:
    """Own names and types; transit is crossing to landing, or as supplied; rings other than 40 and 100 NM go."""
    c = lambda n: clean(col_or_null(raw, n))
    aldt, cross = parse_stamp(c("aldt")), parse_stamp(c("c_time"))
    out = raw.select(
        c("id").alias("ID"), c("fltid").alias("FLTID"), c("adep").alias("ADEP"), c("ades").alias("ICAO"), c("reg").alias("REG"), c("type").alias("TYPE"), c("class").alias("CLASS"), F.coalesce(c("drwy_validado"), c("drwy")).alias("RWY"), c("stnd").alias("STND"),
        aldt.alias("ALDT"), parse_stamp(c("aibt")).alias("AIBT"), parse_stamp(c("sibt")).alias("SIBT"), F.lit("ARR").alias("PHASE"), F.to_date(aldt).alias("DATE"), F.year(aldt).alias("YEAR"), ring_label(c("c")).alias("RANGE"),
        cross.alias("CROSS_TIME"), c("bear").alias("BEARING"), c("setor").alias("SECTOR"), sector_group(c("setor")).alias("SECTOR_GROUP"), F.coalesce(minutes_between(aldt, cross), duration_minutes(c("transito"))).alias("TRANSIT"),
        duration_minutes(c("desimp")).alias("UNIMPEDED"), duration_minutes(c("kpi08")).alias("ADDITIONAL"),
    )
    return out.where(F.col("RANGE").isin(*RINGS))


def once_per_ring(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """The first row of each (ID, RANGE)."""
    return keep_one(df, ("ID", "RANGE"), order)


def daily(df: DataFrame, year: int = REFERENCE_YEAR) -> DataFrame:
    """Sums at the seven-column grain; arrivals without a reference count in MVTS_NA."""
    out = kpi.percentile_kpi(df, spec(year), BY)
    return out.withColumnsRenamed({"TOT": "TOT_TRANSIT", "TOT_ADD": "TOT_ADD_TIME", "TOT_UNIMPEDED": "TOT_SUPPLIED_REF", "TOT_ADDITIONAL": "TOT_SUPPLIED_ADD"})


def wide(df: DataFrame) -> DataFrame:
    """One row an arrival, ``C40_`` and ``C100_`` columns."""
    return widened(df, IDS, "RANGE", RINGS, RING_VALUES)


def long(df: DataFrame) -> DataFrame:
    return lengthened(df, IDS, "RANGE", RINGS, RING_VALUES)


def null_audit(df: DataFrame) -> DataFrame:
    s = spec()
    return kpi.null_audit(df, ("ICAO", "PHASE", "YEAR"), ("RANGE", "CLASS", "RWY", "SECTOR_GROUP"), kpi.is_valid(s))


def reference_coverage(df: DataFrame, year: int = REFERENCE_YEAR) -> DataFrame:
    return kpi.reference_coverage(kpi.reference(df, spec(year), keep_small=True), ("RANGE",), MIN_SAMPLE)


def level_check(df: DataFrame, base_year: int = REFERENCE_YEAR, tolerance: float = 1.0) -> DataFrame:
    """Whether median transits of other years lie within a minute of the base year's, by airport and ring."""
    return kpi.comparability(df.where(kpi.is_valid(spec())), ("ICAO", "RANGE"), "YEAR", base_year, "TRANSIT", tolerance)
