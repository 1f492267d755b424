"""Lists that travel as text: parse, repair, write."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from revlens.functions.text import _col, strip

_STRINGS = "array<string>"


def _no_strings() -> Column:
    return F.array().cast(_STRINGS)


def parse_list(c: Column | str) -> Column:
    """A JSON or single-quoted list as `array<string>`; anything unreadable becomes an empty list."""
    return F.coalesce(F.from_json(_col(c), _STRINGS), _no_strings())


def list_to_json(c: Column | str) -> Column:
    return F.to_json(_col(c))


def repair_json_list(c: Column | str) -> Column:
    """The list re-written as valid JSON text, `[]` when it cannot be read."""
    return list_to_json(parse_list(c))


def split_themes(c: Column | str) -> Column:
    """Comma-separated names, trimmed, lower-cased, without empty parts; NULL gives an empty list."""
    parts = F.transform(F.split(_col(c), ","), lambda part: F.lower(strip(part)))
    return F.coalesce(F.filter(parts, lambda part: part != ""), _no_strings())


def themes_of(c: Column | str) -> Column:
    """Theme names from either JSON text or comma-separated text."""
    text = _col(c)
    from_json = F.transform(parse_list(text), lambda part: F.lower(strip(part)))
    return F.when(strip(text).startswith("["), F.filter(from_json, lambda p: p != "")).otherwise(split_themes(text))


def strip_brackets(c: Column | str) -> Column:
    """Remove list brackets, and the blank after a closing one, from list text."""
    return F.regexp_replace(_col(c), r"\[|\] |]", "")
