"""ISO-8601 durations to whole minutes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(text, pattern, 1).try_cast("int"), F.lit(0))


def duration_minutes(text: Column, style: str = "iso") -> Column:
    """Length of a duration in minutes; null and unreadable text count as 0.

    ``iso`` also counts days, ``plain`` reads hours and minutes only, and
    ``two_digit`` reads at most two digits of each (``PT125M`` gives 25).
    """
    if style == "two_digit":
        return _part(text, "([0-9]{1,2})H") * 60 + _part(text, "([0-9]{1,2})M")
    minutes = _part(text, "([0-9]+)H") * 60 + _part(text, "([0-9]+)M")
    if style == "plain":
        return minutes
    if style == "iso":
        return _part(text, "([0-9]+)D") * 1440 + minutes
    raise ValueError(f"unknown style {style!r}")


def signed_minutes(text: Column) -> Column:
    """Signed difference such as ``PT-6M`` or ``-PT1H``; null stays null."""
    total = (
        _part(text, "(-?[0-9]+)D") * 1440 + _part(text, "(-?[0-9]+)H") * 60 + _part(text, "(-?[0-9]+)M")
    )
    return F.when(text.startswith("-"), -total).when(text.isNotNull(), total)


def minutes_between(later: Column, earlier: Column) -> Column:
    """Exact minutes between two timestamps, as a double."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(6e7)
