"""Schedule and airport listings from other carriers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.schemas import AIRPORT_PAGE, SCHEDULE_PAGE


def _minute_time(name: str) -> Column:
    return F.try_to_timestamp(F.col(name), F.lit("yyyy-MM-dd HH:mm")).alias(name)


def stage_schedules(rows: DataFrame) -> DataFrame:
    """Listing rows with their times as timestamps."""
    times = [
        "dep_time",
        "arr_time",
        "dep_time_utc",
        "arr_time_utc",
        "dep_estimated",
        "arr_estimated",
        "dep_actual",
        "arr_actual",
    ]
    return rows.select(
        "flight_iata",
        "dep_iata",
        "arr_iata",
        "status",
        "airline_iata",
        "flight_number",
        *[_minute_time(name) for name in times],
        "ingested_at",
    )


def scan_schedules(spark: SparkSession, path: str, ingested_at: str, one_page_per_line: bool = False) -> DataFrame:
    rows = (
        spark.read.schema(SCHEDULE_PAGE)
        .option("multiLine", not one_page_per_line)
        .json(path)
        .selectExpr("inline(response)")
        .withColumn("ingested_at", F.lit(ingested_at).cast("timestamp"))
    )
    return stage_schedules(rows)


def scan_airports(spark: SparkSession, path: str, ingested_at: str, one_page_per_line: bool = False) -> DataFrame:
    return (
        spark.read.schema(AIRPORT_PAGE)
        .option("multiLine", not one_page_per_line)
        .json(path)
        .selectExpr("inline(response)")
        .select(
            "iata_code",
            "icao_code",
            "name",
            "lat",
            "lng",
            "country_code",
            "city",
            "timezone",
            F.lit(ingested_at).cast("timestamp").alias("ingested_at"),
        )
    )
