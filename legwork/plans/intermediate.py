"""Intermediate layer: joins, congestion and model features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwork.functions.calendar import instant, local_date, local_hour, weekday
from legwork.functions.durations import duration_minutes, minutes_between
from legwork.functions.keys import leg_id
from legwork.functions.values import has_entries, int_or_zero, is_delayed, is_yes
from legwork.operators.congestion import airport_congestion, attach_congestion
from legwork.operators.normalize import DELAY_KINDS, DELAY_PATHS, LEG_PATHS, entries_of_row, leg_fields
from legwork.plans.raw import LEG_TIMES


def delays_per_leg(delays: DataFrame, how: str = "sum") -> DataFrame:
    """One row per leg: minutes by ``sum``, ``max`` or ``first``, and all its codes.

    Codes are few (two characters), so their set per leg is small; ``first``
    needs the place of each code in its leg.
    """
    minutes = F.coalesce(F.col("delay_duration"), F.lit(0))
    if how == "first":
        value = F.min_by(minutes, "delay_order")
    elif how in ("sum", "max"):
        value = getattr(F, how)(minutes)
    else:
        raise ValueError(f"unknown how {how!r}")
    return delays.groupBy("flight_leg_id").agg(
        value.cast("int").alias("delay_duration_minutes"),
        F.count(F.lit(1)).alias("nb_delays"),
        F.array_join(F.sort_array(F.collect_set("delay_code")), "+").alias("delay_code"),
    )


def int_delays_leg(flights: DataFrame, legs: DataFrame, delays: DataFrame, how: str = "sum") -> DataFrame:
    """Flights, legs and collapsed delays at leg grain, from the raw layer.

    A leg without its flight is dropped. The join on delays comes first, on the
    unique leg id; the flight join then moves each leg once more.
    """
    per_leg = delays_per_leg(delays, how).withColumnRenamed("flight_leg_id", "leg_id")
    carriers = flights.select(
        F.col("id").alias("flight_id"), "flight_number", "flight_schedule_date", "airline_code", "airline_name"
    )
    return (
        legs.withColumnRenamed("id", "leg_id")
        .join(per_leg, "leg_id", "left")
        .join(carriers, "flight_id")
        .select(
            "leg_id",
            "flight_id",
            "flight_number",
            "flight_schedule_date",
            "airline_code",
            "airline_name",
            "leg_order",
            "departure_airport_code",
            "arrival_airport_code",
            "scheduled_departure",
            "actual_departure",
            "scheduled_arrival",
            "actual_arrival",
            "scheduled_departure_text",
            "scheduled_arrival_text",
            "cancelled",
            "aircraft_type_code",
            "delay_code",
            "delay_duration_minutes",
            minutes_between(F.col("actual_departure"), F.col("scheduled_departure")).alias("departure_delay_minutes"),
            minutes_between(F.col("actual_arrival"), F.col("scheduled_arrival")).alias("arrival_delay_minutes"),
            duration_minutes(F.col("scheduled_flight_duration")).alias("scheduled_flight_duration_min"),
        )
    )


def int_delays_nested(documents: DataFrame, how: str = "sum") -> DataFrame:
    """The same rows straight from whole documents.

    A document holds its flight, legs and delays together, so this needs no join
    and no shuffle.
    """
    flight = {
        "flight_id": F.col("id"),
        "flight_number": F.col("flightNumber").try_cast("int"),
        "flight_schedule_date": F.try_to_date("flightScheduleDate", "yyyy-MM-dd"),
        "airline_code": F.col("airline.code"),
        "airline_name": F.col("airline.name"),
    }
    paths = {name: path for name, path in LEG_PATHS.items() if name != "published_status"}
    rows = leg_fields(documents, paths | DELAY_PATHS, flight, DELAY_KINDS).select(
        leg_id(F.col("flight_id"), F.col("position")).alias("leg_id"),
        *flight,
        F.col("position").alias("leg_order"),
        "departure_airport_code",
        "arrival_airport_code",
        *[instant(F.col(name)).alias(name) for name in LEG_TIMES],
        F.col("scheduled_departure").alias("scheduled_departure_text"),
        F.col("scheduled_arrival").alias("scheduled_arrival_text"),
        is_yes(F.col("cancelled")).alias("cancelled"),
        "aircraft_type_code",
        entries_of_row().alias("entries"),
        duration_minutes(F.col("scheduled_flight_duration")).alias("scheduled_flight_duration_min"),
    )
    minutes = F.transform("entries", lambda e: int_or_zero(e["delayDuration"]))
    total = {
        "sum": F.aggregate(minutes, F.lit(0), lambda a, m: a + m),
        "max": F.array_max(minutes),
        "first": F.get(minutes, F.lit(0)),
    }[how]
    codes = F.filter(F.transform("entries", lambda e: e["delayCode"]), lambda c: c.isNotNull())
    late = has_entries(F.col("entries"))
    return rows.withColumns(
        {
            "delay_code": F.when(late, F.array_join(F.array_sort(F.array_distinct(codes)), "+")),
            "delay_duration_minutes": F.when(late, total),
            "departure_delay_minutes": minutes_between(F.col("actual_departure"), F.col("scheduled_departure")),
            "arrival_delay_minutes": minutes_between(F.col("actual_arrival"), F.col("scheduled_arrival")),
        }
    ).drop("entries")


def document_movements(documents: DataFrame) -> DataFrame:
    """Only what congestion counts, so that its scan reads three leaves of each leg."""
    paths = {
        "departure_airport_code": "departureInformation.airport.code",
        "arrival_airport_code": "arrivalInformation.airport.code",
        "scheduled_arrival_text": "arrivalInformation.times.scheduled",
    }
    return leg_fields(
        documents, paths, {"flight_schedule_date": F.try_to_date("flightScheduleDate", "yyyy-MM-dd")}
    ).drop("position")


def int_delays_exploded(documents: DataFrame) -> DataFrame:
    """Legs from whole documents at delay grain: one row per code, one row for a leg without any."""
    rest = [
        "flight_id",
        "flight_number",
        "flight_schedule_date",
        "airline_code",
        "airline_name",
        "leg_order",
        "departure_airport_code",
        "arrival_airport_code",
        "scheduled_departure",
        "actual_departure",
        "scheduled_arrival",
        "actual_arrival",
        "cancelled",
    ]
    return documents.select(*rest, F.explode_outer("delay_info").alias("d")).select(
        *rest,
        F.col("d.delayCode").alias("delay_code"),
        F.col("d.delayDuration").try_cast("int").alias("delay_duration_minutes"),
        minutes_between(F.col("actual_departure"), F.col("scheduled_departure")).alias("departure_delay_minutes"),
        minutes_between(F.col("actual_arrival"), F.col("scheduled_arrival")).alias("arrival_delay_minutes"),
    )


def int_airport_congestion(legs: DataFrame, how: str = "full") -> DataFrame:
    """Congestion from leg rows that carry the schedule date; leg ids are unique after the merge."""
    dated = legs.withColumn("arrival_date", local_date(F.col("scheduled_arrival_text")))
    return airport_congestion(dated, how, unique=True)


def int_legs_ready(delays_leg: DataFrame, congestion: DataFrame, compat: bool = False) -> DataFrame:
    """Everything the mart reads: leg rows with congestion, calendar features and the label.

    ``compat`` fills the departure hour with minutes, as an earlier notebook did.
    """
    dated = delays_leg.withColumn("arrival_date", local_date(F.col("scheduled_arrival_text")))
    return attach_congestion(dated, congestion).withColumns(
        {
            "departure_weekday": weekday(F.col("flight_schedule_date")),
            "departure_month": F.month("flight_schedule_date"),
            "departure_hour": local_hour(F.col("scheduled_departure_text"), compat),
            "departure_monthday": F.dayofmonth("flight_schedule_date"),
            "is_delayed": is_delayed(F.col("delay_duration_minutes")),
        }
    )
