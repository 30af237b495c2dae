"""Keyed merges on plain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in the given order.

    Spark reduces each key to one row before the shuffle (a partial window group
    limit), so a key with very many versions does not fill one task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).where("_rn = 1").drop("_rn")


def merge_by_key(target: DataFrame, updates: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Update rows whose key exists and insert the others; the newest version wins.

    The result does not depend on the order of merges, and a repeated merge
    changes nothing.
    """
    return latest_by_key(target.unionByName(updates, allowMissingColumns=True), keys, order)


def replace_children(
    children: DataFrame,
    parents: DataFrame,
    parent_key: str,
    version: list[str],
    child_parent_key: str | None = None,
) -> DataFrame:
    """Children of the current version of each parent.

    Entries that vanished from a newer parent go too. ``parents`` holds the
    current parents, one row per key, and both sides carry the version columns.
    """
    link = child_parent_key or parent_key
    current = parents.select(F.col(parent_key).alias(link), *version)
    return children.join(current, [link, *version], "left_semi")


def silver_schedules(staging: DataFrame) -> DataFrame:
    """One row per (flight, departure time): the last one ingested."""
    usable = staging.where(F.col("flight_iata").isNotNull() & F.col("dep_time").isNotNull())
    order = [F.desc("ingested_at"), F.desc("status"), F.desc("arr_time"), F.desc("dep_iata"), F.desc("arr_iata")]
    return latest_by_key(usable, ["flight_iata", "dep_time"], order).select(
        "flight_iata",
        "dep_iata",
        "arr_iata",
        "status",
        "dep_time",
        "arr_time",
        F.col("ingested_at").alias("updated_at"),
    )


def silver_airports(staging: DataFrame) -> DataFrame:
    """One row per airport: latest attributes, first and last time it was seen."""
    attributes = ["icao_code", "name", "lat", "lng", "city"]
    newest = F.struct("ingested_at", *attributes)
    return (
        staging.where(F.col("iata_code").isNotNull())
        .groupBy("iata_code")
        .agg(
            F.max(newest).alias("newest"),
            F.min("ingested_at").alias("created_at"),
            F.max("ingested_at").alias("last_updated_at"),
        )
        .select("iata_code", *[f"newest.{name}" for name in attributes], "created_at", "last_updated_at")
    )
