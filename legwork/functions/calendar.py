"""Dates and hours.

Local date and hour come from the text of a timestamp, never from the UTC
instant: ``23:07-05:00`` is already the next day in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def instant(text: Column) -> Column:
    """ISO-8601 text with an offset to a timestamp; unreadable text is null."""
    return text.try_cast("timestamp")


def local_date(text: Column) -> Column:
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def local_hour(text: Column, compat: bool = False) -> Column:
    """Hour of the local time; ``compat`` gives the minute field instead."""
    return F.substring(text, 15 if compat else 12, 2).try_cast("int")


def weekday(date: Column) -> Column:
    """Monday is 0."""
    return F.weekday(date)


def sunday_first(date: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(date) - 1


def day_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def zulu_text(ts: Column) -> Column:
    """Request bound such as ``2026-01-11T00:00:00.000Z``; needs a session in UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.'000Z'")


def date_series(df: DataFrame, column: str, name: str = "date_key") -> DataFrame:
    """One row per day between the first and the last date of a column."""
    bounds = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    days = F.sequence("first", "last", F.expr("interval 1 day"))
    return bounds.where(F.col("first").isNotNull()).select(F.explode(days).alias(name))
