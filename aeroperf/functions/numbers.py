"""Numbers: shares, clamps, classes and lookups."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: Column, whole: Column, digits: int | None = None, percent: bool = True) -> Column:
    """part / whole, in percent, rounded; null for a zero whole."""
    x = F.try_divide(part * (100.0 if percent else 1.0), whole)
    return x if digits is None else F.round(x, digits)


def clamp(c: Column, low: Column | float, high: Column | float) -> Column:
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.least(F.greatest(c, low), high)


def lookup(c: Column, values: dict) -> Column:
    """The value listed for a key; null for any other."""
    return F.create_map(*[F.lit(x) for x in chain(*values.items())])[c]


def sector_group(c: Column) -> Column:
    """A bearing as S000 to S359: whole degrees, modulo 360; null for blank or unreadable text."""
    degrees = F.floor(F.abs(c.try_cast("double"))) * F.signum(c.try_cast("double"))
    return F.when(degrees.isNotNull(), F.format_string("S%03d", F.pmod(degrees.cast("long"), F.lit(360))))


def ring_label(c: Column) -> Column:
    return F.concat(F.lit("C"), c)


def total(c: Column, when: Column | None = None) -> Column:
    """Aggregate: a sum that is 0 over no rows."""
    return F.coalesce(F.sum(F.when(when, c) if when is not None else c), F.lit(0.0))


def count_if(c: Column) -> Column:
    """Aggregate: how often a condition holds; null counts as no."""
    return F.count(F.when(c, True))
