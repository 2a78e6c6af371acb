"""Tower milestones: ingested day by day, flattened, counted; no metric is defined on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aeroperf.operators.coverage import absent_fields, populated
from aeroperf.operators.dedup import distinct_rows
from aeroperf.sources.json_dir import read_json_dir

#: Identity and milestone fields.
IDENTITY = ("Callsign", "EventType", "AcftType", "FlightType", "RV", "Adep", "Ades", "Locality", "Runway", "Transponder", "Equipment")
MILESTONES = ("EOBT", "wPush", "cPush", "wTaxi", "Taxi", "Hold", "cRwy", "cDep", "Dep", "Arr", "ETA", "cPos")


def ingested(spark: SparkSession, path: str) -> DataFrame:
    """All day files, records that repeat in several kept once."""
    return distinct_rows(read_json_dir(spark, path), ("source_file",))


def population(df: DataFrame) -> DataFrame:
    """How much of each milestone is filled, of those the table has."""
    return populated(df, tuple(m for m in MILESTONES if m in df.columns))


def missing_fields(df: DataFrame) -> list[str]:
    return absent_fields(df, IDENTITY + MILESTONES)
