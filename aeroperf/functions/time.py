"""Stamps, durations and calendars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeroperf.config import SENTINEL_BEFORE
from aeroperf.functions.text import clean

#: The spellings of a stamp, most common first; None is ISO, with a space or a T, with or without fractions.
STAMP_FORMATS = (None, "yyyy-MM-dd HH:mm", "dd/MM/yyyy HH:mm:ss", "dd-MM-yyyy HH:mm:ss")


def parse_stamp(c: Column, formats: tuple[str | None, ...] = STAMP_FORMATS) -> Column:
    """A stamp in any of the formats; null for blank or unreadable text."""
    text = clean(c)
    return F.coalesce(*[F.try_to_timestamp(text) if f is None else F.try_to_timestamp(text, F.lit(f)) for f in formats])


def no_sentinel(ts: Column, before: str = SENTINEL_BEFORE) -> Column:
    """Null for stamps before ``before``, which stand for an empty field."""
    return F.when(ts >= F.lit(before).cast("timestamp"), ts)


def minutes_between(later: Column, earlier: Column) -> Column:
    """Minutes with fractions, exact to the microsecond."""
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(60e6)


def duration_minutes(c: Column) -> Column:
    """``[-]H:MM:SS[.s]`` in minutes; null for any other text."""
    pattern = "^(-?)(\\d+):(\\d{1,2}):(\\d{1,2}(?:\\.\\d+)?)$"
    text = clean(c)
    part = lambda i: F.nullif(F.regexp_extract(text, pattern, i), F.lit("")).try_cast("double")
    size = part(2) * 60 + part(3) + part(4) / 60
    return F.when(text.startswith("-"), -size).otherwise(size)


def written_clock(ts: Column, stored_zone: str) -> Column:
    """The clock as it was written, for an instant that carries a zone it was not written in."""
    return F.from_utc_timestamp(ts, stored_zone)


def stored_bounds(start: Column, end: Column, stored_zone: str) -> tuple[Column, Column]:
    """Half-open bounds in written clock as instants of the stored column, so that a filter on it is pushed to the scan."""
    return F.to_utc_timestamp(start, stored_zone), F.to_utc_timestamp(end, stored_zone)


def shifted(ts: Column, minutes: float) -> Column:
    return F.timestamp_micros(F.unix_micros(ts.cast("timestamp")) + F.lit(round(minutes * 60e6)))


def is_midnight(ts: Column) -> Column:
    """Whether the clock is exactly 00:00:00; null stays null."""
    return (F.hour(ts) == 0) & (F.minute(ts) == 0) & (F.second(ts) == 0)


def on_the_hour(ts: Column) -> Column:
    return (F.minute(ts) == 0) & (F.second(ts) == 0)


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def in_written_period(c: Column, years: tuple[int, ...] = (), months: tuple[int, ...] = ()) -> Column:
    """Whether ISO text, or a stamp in written clock, falls in one of the years and one of the months; no years or months are all of them, null is in none."""
    text = c.cast("string")
    ok = text.isNotNull()
    if years:
        ok &= F.substring(text, 1, 4).isin(*[f"{y:04d}" for y in years])
    if months:
        ok &= F.substring(text, 6, 2).isin(*[f"{m:02d}" for m in months])
    return F.coalesce(ok, F.lit(False))
