"""Flights from units' partial records: one key one row, records of a flight chained in time, months joined."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from aeroperf.config import GAP_MIN, MergeSpec, ObservedSteps
from aeroperf.functions.numbers import count_if, share
from aeroperf.functions.text import UNKNOWN_AERODROMES, canonical_list, clean, first_token, token_count
from aeroperf.functions.time import no_sentinel, parse_stamp
from aeroperf.operators.collapse import collapse_same_key
from aeroperf.operators.islands import merge_parts, merged

#: Columns of the archive.
STAMPS = ("dt_dia", "dh_inicio", "dh_fim", "dh_eobt", "dh_eet")
LISTS = ("li_orgaos", "li_tipovoo", "li_regravoo", "li_prnav", "li_rvsm")
PLAIN = ("id", "co_matricula", "co_modelo", "ds_rota")
KEY = ("co_indicativo", "co_addep", "co_addes")


def spec(gap_min: float = GAP_MIN, columns: list[str] | None = None) -> MergeSpec:
    """How flights are chained; with ``columns`` only of those a table has."""
    held = lambda names: tuple(c for c in names if columns is None or c in columns)
    return MergeSpec(KEY, "dh_inicio", "dh_fim", order=("pk",), gap_min=gap_min, union_cols=held(LISTS), filled_cols=held(("pk", "dt_dia", "dh_eobt", "dh_eet", *PLAIN)), identity="pk", prefer_filled="co_matricula" if columns is None or "co_matricula" in columns else None)


def normalised(df: DataFrame) -> DataFrame:
    """Keys in upper case, stamps parsed and without the epoch sentinel, list columns canonical."""
    out = df.toDF(*[c.lower() for c in df.columns])
    for c in out.columns:
        kind = dict(out.dtypes)[c]
        if c in STAMPS:
            out = out.withColumn(c, no_sentinel(parse_stamp(F.col(c)) if kind == "string" else F.col(c).cast("timestamp")))
        elif c in LISTS:
            out = out.withColumn(c, canonical_list(F.array_join(c, "|") if kind.startswith("array") else F.col(c)))
        elif kind == "string":
            out = out.withColumn(c, F.upper(clean(F.col(c))) if c == "pk" else clean(F.col(c)))
    return out


def prepared(df: DataFrame, gap_min: float = GAP_MIN, places: bool = False) -> DataFrame:
    """Normalised, one row a key, then one row a flight; with ``places``, as ``joined_months`` needs to equal one run over all months."""
    rows = normalised(df)
    one = collapse_same_key(rows, "pk", ("dh_inicio", "dh_fim"), tuple(c for c in LISTS if c in rows.columns)).drop("N_KEY_MERGED")
    return merged(one, spec(gap_min, one.columns), places=places)


def prepared_with_steps(df: DataFrame, gap_min: float = GAP_MIN) -> ObservedSteps:
    """The same, with the rows of each step: counted on the way, by the job that uses the frame, not by jobs of their own."""
    rows, keys, flights = normalised(df), Observation(), Observation()
    one = collapse_same_key(rows, "pk", ("dh_inicio", "dh_fim"), tuple(c for c in LISTS if c in rows.columns))
    one = one.observe(keys, F.count("*").alias("kept"), F.coalesce(F.sum(F.col("N_KEY_MERGED") - 1), F.lit(0)).alias("collapsed"))
    out = merged(one.drop("N_KEY_MERGED"), spec(gap_min, one.columns)).observe(flights, F.count("*").alias("out"))

    def steps() -> dict[str, int]:
        k, n = keys.get, flights.get["out"]
        return {"read": k["kept"] + k["collapsed"], "collapsed": k["collapsed"], "kept": k["kept"], "merged": k["kept"] - n, "out": n}

    return ObservedSteps(out, steps)


def joined_months(months: list[DataFrame], gap_min: float = GAP_MIN) -> DataFrame:
    """Months prepared on their own, flights across their bounds joined; provenance is kept."""
    return merge_parts(months, spec(gap_min, months[0].columns))


def unit_counts(df: DataFrame) -> DataFrame:
    """Flights by the number of units that saw them."""
    return df.groupBy(F.coalesce(token_count(F.col("li_orgaos")), F.lit(0)).alias("units")).agg(F.count("*").alias("n"))


def traffic_profile(df: DataFrame, by: tuple[str, ...], rules: str = "li_regravoo", kind: str = "li_tipovoo") -> DataFrame:
    """Shares (percent) of flights by rule (I, V) and type (S, G) of their first unit, and of those without an aerodrome at either end."""
    first = lambda c: first_token(F.col(c))
    pct = lambda cond, name: share(count_if(cond), F.count("*"), 4).alias(name)
    missing = lambda c: clean(F.col(c)).isNull() | F.col(c).isin(*UNKNOWN_AERODROMES)
    return df.groupBy(*by).agg(F.count("*").alias("n"), pct(first(rules) == "I", "pct_ifr"), pct(first(rules) == "V", "pct_vfr"), pct(first(kind) == "S", "pct_scheduled"), pct(first(kind) == "G", "pct_general"), pct(missing("co_addep") | missing("co_addes"), "pct_no_aerodrome"))
