"""Payloads of the dashboards: averages at airport, region and month grain, nested."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroperf.functions.numbers import share


def leaves(sums: DataFrame, by: tuple[str, ...], total: str = "TOT_TXXT") -> DataFrame:
    """mvts, avg, avg_ref, avg_add and na_share for each group of a daily table: ratios of sums."""
    agg = sums.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("MVTS_VALID", "MVTS_NA", total, "TOT_REF", "TOT_ADD_TIME")])
    v, every = F.col("MVTS_VALID"), F.col("MVTS_VALID") + F.col("MVTS_NA")
    r = lambda c: share(F.col(c), v, 6, percent=False)
    return agg.select(*by, F.struct(every.alias("mvts"), r(total).alias("avg"), r("TOT_REF").alias("avg_ref"), r("TOT_ADD_TIME").alias("avg_add"), share(F.col("MVTS_NA"), every, 6, percent=False).alias("na_share")).alias("leaf"))


def taxi_payload(sums: DataFrame) -> dict[str, DataFrame]:
    """airports, overall and monthly parts of a daily table with REGION, ICAO, PHASE and DATE."""
    from aeroperf.sinks.files import payload_json

    df = sums.withColumns({"YEAR": F.date_format("DATE", "yyyy"), "MM": F.date_format("DATE", "MM")})
    parts = {"airports": ("REGION", "ICAO", "PHASE", "YEAR"), "overall": ("REGION", "YEAR", "PHASE"), "monthly": ("REGION", "YEAR", "PHASE", "MM")}
    return {name: payload_json(leaves(df, by), by, F.col("leaf.avg_add") if name == "monthly" else F.col("leaf")) for name, by in parts.items()}
