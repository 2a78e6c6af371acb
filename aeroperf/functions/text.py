"""Text columns: trimming, keys, classes, lists of tokens. All are Catalyst expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spellings of true and false, and shapes of identifiers.
TRUE_WORDS = ("T", "TRUE", "1", "Y", "S", "SIM")
FALSE_WORDS = ("F", "FALSE", "0", "N", "NAO", "NO")
REGISTRATION, AIRLINE_CALLSIGN, BRAZILIAN_AERODROME, HEX = "^P[PRSTU][A-Z]{3}$", "^[A-Z]{3}[0-9]", "^S[BDIJNSW]", "^[0-9A-F]+$"
UNKNOWN_AERODROMES = ("AFIL", "ZZZZ")


def trimmed(c: Column) -> Column:
    """Without spaces, tabs and line ends at either end."""
    return F.trim(c, F.lit(" \t\r\n"))


def clean(c: Column) -> Column:
    """Trimmed; null where nothing is left."""
    return F.nullif(trimmed(c), F.lit(""))


def key_text(c: Column) -> Column:
    """Trimmed upper case, as keys are compared."""
    return F.upper(trimmed(c))


def recode(c: Column, values: dict[str, str]) -> Column:
    """New values for those listed; null for all others."""
    return reduce(lambda out, kv: out.when(c == kv[0], kv[1]), list(values.items())[1:], F.when(c == next(iter(values)), values[next(iter(values))]))


def truth(c: Column) -> Column:
    """A spelled-out boolean as ``TRUE`` or ``FALSE``; other text as it is, in upper case."""
    k = key_text(c)
    return F.when(k.isin(*TRUE_WORDS), "TRUE").when(k.isin(*FALSE_WORDS), "FALSE").otherwise(F.nullif(k, F.lit("")))


def stamp_text(c: Column) -> Column:
    """The first 19 characters of a stamp, with a space for ``T``."""
    return F.nullif(F.substring(F.regexp_replace(trimmed(c), "T", " "), 1, 19), F.lit(""))


def col_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column of that name, whatever its case or underscores; a null if the table has none."""
    found = {flat_name(c): c for c in df.columns}.get(flat_name(name))
    return F.col(f"`{found}`") if found else F.lit(None).cast(kind)


def flat_name(name: str) -> str:
    """A header as it is matched: lower case, letters and digits only."""
    return re.sub("[^a-z0-9]", "", name.lower())


def matches(c: Column, pattern: str) -> Column:
    """Whether a pattern is found; null counts as no."""
    return F.coalesce(c.rlike(pattern), F.lit(False))


def scope_class(dep: Column, arr: Column, home: str = BRAZILIAN_AERODROME) -> Column:
    """domestic, international or none, by two aerodromes: none when either is missing or not a place."""
    missing = lambda c: clean(c).isNull() | c.isin(*UNKNOWN_AERODROMES)
    return F.when(missing(dep) | missing(arr), "none").when(matches(dep, home) & matches(arr, home), "domestic").otherwise("international")


def tokens(c: Column, separators: str = "[\\|,]") -> Column:
    """Distinct trimmed tokens of a list in text, sorted, without blanks; null gives an empty array."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), separators), trimmed)
    return F.array_sort(F.array_distinct(F.filter(parts, lambda x: x != "")))


def canonical_list(c: Column, separators: str = "[\\|,]", sep: str = "|") -> Column:
    """A list in text in its one spelling; null when it holds nothing."""
    return F.nullif(F.array_join(tokens(c, separators), sep), F.lit(""))


def union_of_lists(c: Column, separators: str = "[\\|,]", sep: str = "|") -> Column:
    """Aggregate: the canonical list of all tokens of a group. Lists are told apart as text, and taken apart once a group; ``sep`` must be one of the separators."""
    return canonical_list(F.array_join(F.collect_set(c), sep), separators, sep)


def first_token(c: Column, sep: str = "|") -> Column:
    return F.substring_index(c, sep, 1)


def token_count(c: Column, sep: str = "\\|") -> Column:
    return F.size(F.split(c, sep))


def flat_array(c: Column, sep: str = "|") -> Column:
    """An array column as text; an empty one is null."""
    return F.when(F.size(c) > 0, F.array_join(c, sep))


def filled(c: Column) -> Column:
    """Whether a value is neither null nor blank."""
    return c.isNotNull() & (trimmed(c.cast("string")) != "")


def first_filled(c: Column, order: Column) -> Column:
    """Aggregate: the first value in ``order`` that is neither null nor blank; null when there is none."""
    return F.min_by(c, F.when(filled(c), order))
