"""Row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the DNS name space of RFC 4122, as hex
NAMESPACE_DNS = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace: str = NAMESPACE_DNS) -> Column:
    """RFC 4122 version 5 id of a name, in canonical lower case."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def leg_id(flight_id: Column, position: Column) -> Column:
    return uuid5(F.concat(flight_id, F.lit("_"), position.cast("string")))


def delay_id(flight_id: Column, position: Column, entry: Column) -> Column:
    return uuid5(F.concat(flight_id, F.lit("_"), position.cast("string"), F.lit("_"), entry.cast("string")))


def plus_key(*parts: Column) -> Column:
    """Parts joined by ``+``; null as soon as one part is null."""
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit("+"), part]
    return F.concat(*pieces)


def pair_key(left: Column, right: Column) -> Column:
    """The same key for a pair in either order."""
    return plus_key(
        F.when(left <= right, left).otherwise(right),
        F.when(left <= right, right).otherwise(left),
    )


def parse_flight_id(flight_id: Column) -> Column:
    """Split ``yyyyMMdd+carrier+number[+suffix]``; parts that are absent are null."""
    parts = F.split(flight_id, r"\+")
    return F.struct(
        F.try_to_date(F.get(parts, F.lit(0)), "yyyyMMdd").alias("schedule_date"),
        F.get(parts, F.lit(1)).alias("carrier"),
        F.get(parts, F.lit(2)).alias("number"),
        F.get(parts, F.lit(3)).alias("suffix"),
    )
