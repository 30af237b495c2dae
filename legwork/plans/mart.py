"""Mart layer: the leg fact and its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legwork.functions.calendar import date_series, day_name, sunday_first

# Column of the intermediate model and its name in the fact
FACT_COLUMNS = [
    ("leg_id", "leg_id"),
    ("flight_id", "flight_id"),
    ("flight_number", "flight_number"),
    ("airline_code", "airline_key"),
    ("departure_airport_code", "departure_airport_key"),
    ("arrival_airport_code", "arrival_airport_key"),
    ("flight_schedule_date", "date_key"),
    ("scheduled_departure", "scheduled_departure"),
    ("actual_departure", "actual_departure"),
    ("scheduled_arrival", "scheduled_arrival"),
    ("actual_arrival", "actual_arrival"),
    ("cancelled", "cancelled"),
    ("delay_code", "delay_code"),
    ("delay_duration_minutes", "delay_duration_minutes"),
    ("departure_delay_minutes", "departure_delay_minutes"),
    ("arrival_delay_minutes", "arrival_delay_minutes"),
    ("scheduled_flight_duration_min", "scheduled_flight_duration_min"),
    ("aircraft_type_code", "aircraft_type_code"),
    ("departure_weekday", "departure_weekday"),
    ("departure_month", "departure_month"),
    ("departure_hour", "departure_hour"),
    ("departure_monthday", "departure_monthday"),
    ("dep_airport_nb_departing", "dep_airport_nb_departing"),
    ("dep_airport_nb_arriving", "dep_airport_nb_arriving"),
    ("arr_airport_nb_departing", "arr_airport_nb_departing"),
    ("arr_airport_nb_arriving", "arr_airport_nb_arriving"),
    ("is_delayed", "is_delayed"),
]


def fct_flight_legs(legs_ready: DataFrame) -> DataFrame:
    return legs_ready.select(*[F.col(source).alias(name) for source, name in FACT_COLUMNS])


def dim_airlines(legs: DataFrame, version: str = "flight_schedule_date") -> DataFrame:
    """One row per carrier; the name on the latest date wins, then the last in order."""
    return (
        legs.where(F.col("airline_code").isNotNull())
        .groupBy(F.col("airline_code").alias("airline_key"))
        .agg(F.max(F.struct(version, "airline_name")).alias("newest"))
        .select("airline_key", F.col("airline_key").alias("airline_code"), "newest.airline_name")
    )


def dim_airports(legs: DataFrame) -> DataFrame:
    """Every airport in either role, from one pass."""
    codes = legs.select(F.explode(F.array("departure_airport_code", "arrival_airport_code")).alias("airport_key"))
    return codes.where(F.col("airport_key").isNotNull()).distinct().withColumn("airport_code", F.col("airport_key"))


def dim_date(legs: DataFrame) -> DataFrame:
    day = F.col("date_key")
    return date_series(legs, "flight_schedule_date").select(
        "date_key",
        sunday_first(day).alias("day_of_week"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        day_name(day).alias("day_name"),
    )


def with_surrogate_key(dim: DataFrame, natural_key: str, name: str = "surrogate_key", how: str = "dense") -> DataFrame:
    """Number the rows of a dimension.

    ``dense`` gives 1..n in key order and suits dimensions keyed by carrier,
    airport or day, whose codes bound their size. ``hash`` works without a sort
    at any size.
    """
    if how == "hash":
        return dim.withColumn(name, F.xxhash64(natural_key))
    return dim.withColumn(name, F.row_number().over(Window.orderBy(natural_key)))


def star_join(fact: DataFrame, airlines: DataFrame, airports: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact with its carrier, both airports and its date.

    No side is forced: Spark broadcasts a dimension that is below its size
    limit and splits hot keys where it is not.
    """

    def role(name: str) -> DataFrame:
        return airports.select(*[F.col(c).alias(f"{name}_{c}") for c in airports.columns])

    return (
        fact.join(airlines, "airline_key", "left")
        .join(role("departure"), "departure_airport_key", "left")
        .join(role("arrival"), "arrival_airport_key", "left")
        .join(dates, "date_key", "left")
    )
