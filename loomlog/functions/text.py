"""String, number and time expressions. All are plain column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomlog import fixed_values as fv

_NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row however often ``body`` mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def to_number(col: Column) -> Column:
    """Text to double; anything that is not a plain decimal number becomes null."""
    text = col.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def contains_any(lowered: Column, words: Sequence[str]) -> Column:
    """Does already lower-cased text contain any of the words as substrings?"""
    out = F.lit(False)
    for word in words:
        out = out | lowered.contains(word)
    return out


def extract_or_null(col: Column, pattern: str, group: int = 1) -> Column:
    """Regex group, null when the pattern does not match or the group is empty."""
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def first_extract(col: Column, patterns: Sequence[str], group: int = 1) -> Column:
    """The group of the first pattern that matches."""
    return F.coalesce(*[extract_or_null(col, p, group) for p in patterns])


def extract_timestamp(col: Column, kind: str) -> Column:
    return extract_or_null(col, fv.TIMESTAMP_FINDERS[kind])


def extract_level(col: Column, kind: str = "standard") -> Column:
    return extract_or_null(col, fv.LEVEL_FINDERS[kind])


def parse_time(col: Column, *formats: str) -> Column:
    """First format that parses, as a timestamp without zone; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)).cast("timestamp_ntz") for f in formats])


def parse_month_day(col: Column, year: int) -> Column:
    """``MMM d HH:mm:ss`` in ``year``, days of one or two digits; null when it does not parse."""
    text = F.trim(F.regexp_replace(col, r"\s+", " "))
    return parse_time(F.concat(F.lit(f"{year} "), text), "yyyy MMM d HH:mm:ss")


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole * 100``, 0 for an empty whole."""
    value = F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))
    return value if digits is None else F.round(value, digits)


def split_request(request: Column) -> tuple[Column, Column]:
    """``method`` and ``path`` from a request line, cut at the first two spaces."""
    parts = F.split(request, " ", 3)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def in_zone(ts: Column, zone: str = "+05:30") -> Column:
    """A UTC instant shown on another zone's wall clock."""
    return F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM-dd HH:mm:ss")
