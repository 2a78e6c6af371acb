"""Taxi time: one airport movement a row, additional time against a reference by stand and runway."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroperf.config import MIN_SAMPLE, REFERENCE_P, REFERENCE_YEAR, TAXI_CAP_MIN, TAXI_KEY, KpiSpec
from aeroperf.functions.text import clean, col_or_null, key_text, recode, stamp_text, truth
from aeroperf.functions.time import minutes_between, parse_stamp
from aeroperf.operators import kpi

#: Columns of the raw file, and the field that some of its rows have beyond its header.
RAW = ["mov", "matricula", "indicativo", "adpartida", "addestino", "tipovoo", "vra_tipo_linha", "companhia", "tipoaeronave", "dh_bimtra", "dh_vra", "box", "pista", "match_vra"]
EXTRA = ("V15",)
COMPARED = ("matricula", "tipoaeronave", "box", "pista", "dh_vra", "match_vra", "tipovoo", "vra_tipo_linha", "companhia")


def spec(year: int = REFERENCE_YEAR, window_col: str = "BLOCK_TIME") -> KpiSpec:
    return KpiSpec(TAXI_KEY, "TXXT", "DATE", TAXI_CAP_MIN, p=REFERENCE_P, min_n=MIN_SAMPLE, window_col=window_col, window=(f"{year}-01-01 00:00:00", f"{year}-12-31 23:59:59"))


def harmonised(raw: DataFrame, airports: tuple[str, ...] | None = None) -> DataFrame:
    """Own names and types; an unknown phase is null and so has no airport. With ``airports`` only theirs."""
    c = lambda n: clean(col_or_null(raw, n))
    out = raw.select(
        recode(c("mov"), {"Arr": "ARR", "Dep": "DEP"}).alias("PHASE"), parse_stamp(c("dh_bimtra")).alias("MVT_TIME"), parse_stamp(c("dh_vra")).alias("BLOCK_TIME"), c("box").alias("STND"), c("pista").alias("RWY"),
        c("adpartida").alias("ADEP"), c("addestino").alias("ADES"), c("indicativo").alias("FLTID"), c("matricula").alias("REG"), c("tipoaeronave").alias("ARCTYP"), c("match_vra").alias("MATCH"), c("V15").alias("PAYLOAD"),
    ).withColumn("ICAO", F.when(F.col("PHASE") == "ARR", F.col("ADES")).when(F.col("PHASE") == "DEP", F.col("ADEP")))
    return out.where(F.col("ICAO").isin(*airports)) if airports else out


def measured(df: DataFrame) -> DataFrame:
    """Adds TXXT in minutes (block after landing, take-off after block) and DATE (of the block, else of the movement)."""
    txxt = F.when(F.col("PHASE") == "ARR", minutes_between(F.col("BLOCK_TIME"), F.col("MVT_TIME"))).when(F.col("PHASE") == "DEP", minutes_between(F.col("MVT_TIME"), F.col("BLOCK_TIME")))
    return df.withColumns({"TXXT": txxt, "DATE": F.to_date(F.coalesce("BLOCK_TIME", "MVT_TIME"))})


def daily(df: DataFrame, year: int = REFERENCE_YEAR) -> DataFrame:
    """ICAO, PHASE, DATE, MVTS_VALID, MVTS_NA, TOT_TXXT, TOT_REF, TOT_ADD_TIME."""
    out = kpi.percentile_kpi(measured(df), spec(year), ("ICAO", "PHASE", "DATE"))
    return out.withColumnsRenamed({"TOT": "TOT_TXXT", "TOT_ADD": "TOT_ADD_TIME"})


def coverage(sums: DataFrame) -> DataFrame:
    """By year and phase."""
    return kpi.rolled_up(sums.withColumn("YEAR", F.year("DATE")), ("YEAR", "PHASE"))


def reference_windows(df: DataFrame, year: int = REFERENCE_YEAR) -> dict[str, DataFrame]:
    """Daily tables under each definition of the reference window: none, by date, by movement, by block."""
    m = measured(df).withColumn("_day", F.col("DATE").cast("timestamp"))
    by = {"none": None, "date": "_day", "movement": "MVT_TIME", "block": "BLOCK_TIME"}
    out = {}
    for name, column in by.items():
        s = spec(year, column or "BLOCK_TIME")
        s = s if column else KpiSpec(s.key, s.duration, s.day, s.cap, p=s.p, min_n=s.min_n)
        out[name] = kpi.percentile_kpi(m, s, ("ICAO", "PHASE", "DATE")).withColumnsRenamed({"TOT": "TOT_TXXT", "TOT_ADD": "TOT_ADD_TIME"})
    return out


def comparison_key(df: DataFrame) -> DataFrame:
    """Rows with the key that two sources are compared by, and the compared fields in one spelling."""
    c = lambda n: key_text(col_or_null(df, n))
    key = F.concat_ws("|", *[F.coalesce(x, F.lit("")) for x in (c("indicativo"), c("mov"), stamp_text(col_or_null(df, "dh_bimtra")), c("adpartida"), c("addestino"))])
    fields = [(truth(col_or_null(df, f)) if f == "match_vra" else stamp_text(col_or_null(df, f)) if f == "dh_vra" else F.nullif(c(f), F.lit(""))).alias(f) for f in COMPARED]
    return df.select(key.alias("key"), *fields)


def ingest_year(spark, paths: list[str], year: int, out: str, airports: tuple[str, ...] | None = None) -> DataFrame:
    """Read a year's files (the year's by name, or unnamed ones), harmonise them and write them as that year's parquet; what was written."""
    from aeroperf.sinks.files import write_by_year
    from aeroperf.sources.catalog import for_years
    from aeroperf.sources.delimited import read_delimited

    df = harmonised(read_delimited(spark, for_years(paths, {year}), RAW, extra=EXTRA), airports)
    write_by_year(df, out, F.lit(year))
    return spark.read.parquet(out).where(F.col("YEAR") == year)
