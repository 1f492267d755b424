"""Dates and time buckets, independent of the session time zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from revlens.functions.text import _col, strip
from revlens.functions.vocab import MISSING_DATE_MARKERS

# What follows a time of day: an offset, Z or the name of a zone.
_ZONE = r"\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*([A-Za-z+-].*)$"
_DAY = 86_400_000_000


def parse_timestamp(c: Column | str, formats: Sequence[str] = ()) -> Column:
    """Text to a UTC wall-clock timestamp; text that cannot be read becomes NULL.

    Text without a zone counts as UTC; a zone may be Z, an offset such as +03, +0300 or UTC+3, or a name, and one
    that is unknown makes the text unreadable. `formats` are tried in turn after the ISO forms.
    """
    text = strip(c)
    text = F.when(~text.isin(list(MISSING_DATE_MARKERS)), text)
    zoned = F.regexp_extract(text, _ZONE, 1) != ""
    # An instant is the same in every session; its distance from the epoch is the wall clock of UTC.
    micros = F.unix_micros(text.try_cast("timestamp"))
    seconds = (F.pmod(micros, F.lit(_DAY)) / 1_000_000).cast("decimal(18,6)")
    days = F.floor(micros / _DAY).cast("int")
    instant = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)
    parsed = F.when(zoned, instant).otherwise(text.try_cast("timestamp_ntz"))
    others = [F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in formats]
    return F.coalesce(parsed, *others)


def parse_timestamp_strict(c: Column | str) -> Column:
    """As `parse_timestamp`, but text that is present and unreadable fails the query."""
    text = strip(c)
    present = ~text.isin(list(MISSING_DATE_MARKERS))
    parsed = parse_timestamp(c)
    bad = present & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a timestamp: "), text))).otherwise(parsed)


def date_text(c: Column | str) -> Column:
    return F.date_format(F.to_date(_col(c)), "yyyy-MM-dd")


def week_ending(c: Column | str) -> Column:
    """The Sunday that closes the week of a date or timestamp."""
    return F.date_add(F.to_date(F.date_trunc("week", _col(c))), 6)
