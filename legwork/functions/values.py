"""Small value rules: defaults, flags, parallel lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DELAYED_FROM_MINUTES = 15


def first_or(values: Column, default: str) -> Column:
    """First entry of a list; the default for a null or empty one."""
    return F.when(F.coalesce(F.size(values), F.lit(0)) > 0, F.get(values, F.lit(0))).otherwise(F.lit(default))


def is_yes(flag: Column) -> Column:
    """``Y`` is true; anything else, null included, is false."""
    return F.coalesce(flag == "Y", F.lit(False))


def int_or_zero(value: Column) -> Column:
    return F.coalesce(value.try_cast("int"), F.lit(0))


def has_entries(values: Column) -> Column:
    return F.coalesce(F.size(values), F.lit(0)) > 0


def zip_short(codes: Column, durations: Column) -> Column:
    """Pairs of two parallel lists, cut to the shorter one."""
    length = F.least(F.coalesce(F.size(codes), F.lit(0)), F.coalesce(F.size(durations), F.lit(0)))
    return F.transform(
        F.slice(codes, F.lit(1), F.greatest(length, F.lit(0))),
        lambda code, i: F.struct(code.alias("delayCode"), F.get(durations, i).alias("delayDuration")),
    )


def delay_entries(irregularity: Column | dict[str, Column]) -> Column:
    """Delays of a leg: the structured list if it has entries, else the parallel lists."""
    structured = irregularity["delayInformation"]
    return F.when(
        has_entries(structured),
        F.transform(
            structured,
            lambda e: F.struct(e["delayCode"].alias("delayCode"), e["delayDuration"].alias("delayDuration")),
        ),
    ).otherwise(zip_short(irregularity["delayCode"], irregularity["delayDuration"]))


def is_delayed(minutes: Column) -> Column:
    return F.coalesce(minutes, F.lit(0)) >= DELAYED_FROM_MINUTES
