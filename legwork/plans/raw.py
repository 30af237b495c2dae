"""Raw layer: casts and renames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwork.functions.calendar import instant
from legwork.operators.normalize import DELAY_KINDS, DELAY_PATHS, LEG_PATHS, entries_of_row, leg_fields

LEG_TIMES = ["scheduled_departure", "actual_departure", "scheduled_arrival", "actual_arrival"]


def raw_flights(flights: DataFrame) -> DataFrame:
    return flights.select(
        "id",
        F.col("flight_number").try_cast("int").alias("flight_number"),
        F.try_to_date("flight_schedule_date", "yyyy-MM-dd").alias("flight_schedule_date"),
        "airline_code",
        "airline_name",
        "haul",
        "route",
        "flight_status_public",
        F.col("fetched_at").try_cast("timestamp").alias("fetched_at"),
    )


def raw_legs(legs: DataFrame) -> DataFrame:
    """Times become instants; their text stays beside them, as local date and hour come from it."""
    return legs.select(
        F.lower("id").alias("id"),
        "flight_id",
        F.col("leg_order").try_cast("int").alias("leg_order"),
        "departure_airport_code",
        "arrival_airport_code",
        "published_status",
        *[instant(F.col(c)).alias(c) for c in LEG_TIMES],
        F.col("scheduled_departure").alias("scheduled_departure_text"),
        F.col("scheduled_arrival").alias("scheduled_arrival_text"),
        "scheduled_flight_duration",
        F.col("cancelled").try_cast("boolean").alias("cancelled"),
        "aircraft_type_code",
    )


def raw_delays(delays: DataFrame) -> DataFrame:
    """Delay durations as whole minutes."""
    return delays.select(
        F.lower("id").alias("id"),
        F.lower("flight_leg_id").alias("flight_leg_id"),
        "delay_code",
        F.col("delay_duration").try_cast("int").alias("delay_duration"),
        *[c for c in ["delay_order"] if c in delays.columns],
    )


def raw_documents(docs: DataFrame) -> DataFrame:
    """Legs straight from whole documents, with their delay entries as an array."""
    flight = {
        "flight_id": F.col("id"),
        "flight_number": F.col("flightNumber").try_cast("int"),
        "flight_schedule_date": F.try_to_date("flightScheduleDate", "yyyy-MM-dd"),
        "haul": F.col("haul"),
        "route": F.col("route"),
        "airline_code": F.col("airline.code"),
        "airline_name": F.col("airline.name"),
        "flight_status_public": F.col("flightStatusPublic"),
        "fetched_at": F.col("fetched_at"),
    }
    rows = leg_fields(docs, LEG_PATHS | DELAY_PATHS, flight, DELAY_KINDS)
    return rows.select(
        *[name for name in flight if name != "fetched_at"],
        F.col("position").alias("leg_order"),
        "departure_airport_code",
        "arrival_airport_code",
        F.col("published_status").alias("leg_status"),
        *[instant(F.col(name)).alias(name) for name in LEG_TIMES],
        "scheduled_flight_duration",
        (F.col("cancelled") == "Y").alias("cancelled"),
        entries_of_row().alias("delay_info"),
        "fetched_at",
    )
