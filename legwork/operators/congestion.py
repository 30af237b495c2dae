"""How many legs leave and reach an airport on a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _movements(legs: DataFrame, airport: str, day: Column, leg_key: str) -> DataFrame:
    return legs.select(
        F.col(airport).alias("airport_code"), day.alias("movement_date"), F.col(leg_key).alias("leg_key")
    )


def _count_legs(movements: DataFrame, keys: list[str], unique: bool, name: str) -> DataFrame:
    """Legs per key. Repeated leg ids are removed in a first, partially combined pass."""
    if unique:
        return movements.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    legs = movements.groupBy(*keys, "leg_key").agg(F.count(F.lit(1)).alias("_copies"))
    return legs.groupBy(*keys).agg(F.count("leg_key").alias(name))


def departures(
    legs: DataFrame,
    airport: str = "departure_airport_code",
    day: str = "flight_schedule_date",
    leg_key: str = "leg_id",
    unique: bool = False,
) -> DataFrame:
    """Departing legs per airport and schedule date. Set ``unique`` for legs already merged by key."""
    rows = _movements(legs, airport, F.col(day), leg_key)
    return _count_legs(rows, ["airport_code", "movement_date"], unique, "nb_departing")


def arrivals(
    legs: DataFrame,
    airport: str = "arrival_airport_code",
    day: str = "arrival_date",
    leg_key: str = "leg_id",
    unique: bool = False,
) -> DataFrame:
    """Arriving legs per airport and local arrival date."""
    rows = _movements(legs, airport, F.col(day), leg_key)
    return _count_legs(rows, ["airport_code", "movement_date"], unique, "nb_arriving")


def airport_congestion(legs: DataFrame, how: str = "full", unique: bool = False) -> DataFrame:
    """Departing and arriving legs per airport-day.

    ``full`` keeps days with one direction only and counts the other as 0;
    ``inner`` drops them. Both directions are counted in one grouped pass, so
    no join is needed and hub airports are combined before the shuffle. ``unique``
    counts rows, for legs that were already merged by key.
    """
    if how not in ("full", "inner"):
        raise ValueError(f"unknown how {how!r}")
    sides = F.array(
        F.struct(
            F.col("departure_airport_code").alias("airport_code"),
            F.col("flight_schedule_date").alias("movement_date"),
            F.lit(True).alias("departing"),
        ),
        F.struct(
            F.col("arrival_airport_code").alias("airport_code"),
            F.col("arrival_date").alias("movement_date"),
            F.lit(False).alias("departing"),
        ),
    )
    keys = ["airport_code", "movement_date"]
    if unique:
        rows = legs.select(F.explode(sides).alias("side")).select("side.*")
        leg = F.lit(1)
    else:
        rows = legs.select("leg_id", F.explode(sides).alias("side")).select("leg_id", "side.*")
        rows = rows.groupBy(*keys, "departing", "leg_id").agg(F.count(F.lit(1)).alias("_copies"))
        leg = F.col("leg_id")
    counted = rows.groupBy(*keys).agg(
        F.count(F.when(F.col("departing"), leg)).alias("nb_departing"),
        F.count(F.when(~F.col("departing"), leg)).alias("nb_arriving"),
        F.max("departing").alias("_any_departing"),
        F.min("departing").alias("_all_departing"),
    )
    if how == "inner":
        both = F.col("_any_departing") & ~F.col("_all_departing")
        counted = counted.where(both & F.col("airport_code").isNotNull() & F.col("movement_date").isNotNull())
    return counted.drop("_any_departing", "_all_departing")


def attach_congestion(legs: DataFrame, congestion: DataFrame) -> DataFrame:
    """Counts of the departure airport on the schedule date and of the arrival airport on the arrival date.

    Spark broadcasts the counts while they are small by its own size check, and
    splits busy airport-days otherwise.
    """
    at_departure = congestion.select(
        F.col("airport_code").alias("departure_airport_code"),
        F.col("movement_date").alias("flight_schedule_date"),
        F.col("nb_departing").alias("dep_airport_nb_departing"),
        F.col("nb_arriving").alias("dep_airport_nb_arriving"),
    )
    at_arrival = congestion.select(
        F.col("airport_code").alias("arrival_airport_code"),
        F.col("movement_date").alias("arrival_date"),
        F.col("nb_departing").alias("arr_airport_nb_departing"),
        F.col("nb_arriving").alias("arr_airport_nb_arriving"),
    )
    return legs.join(at_departure, ["departure_airport_code", "flight_schedule_date"], "left").join(
        at_arrival, ["arrival_airport_code", "arrival_date"], "left"
    )


MOVEMENT = ["airport_code", "movement_date"]


def congestion_changes(old_legs: DataFrame, new_legs: DataFrame) -> DataFrame:
    """What legs that were replaced, and those that replace them, change per airport-day.

    Returns ``airport_code, movement_date`` and the changes of both counts, of the
    airport-days where one changes. A leg that moved, or went, is taken off where it was.
    """
    sides = []
    for legs, sign in ((old_legs, -1), (new_legs, 1)):
        counted = airport_congestion(legs, unique=True)
        sides.append(counted.select(*MOVEMENT, *[(F.col(c) * sign).alias(c) for c in ("nb_departing", "nb_arriving")]))
    changes = sides[0].unionByName(sides[1]).groupBy(*MOVEMENT)
    changes = changes.agg(*[F.sum(c).alias(f"{c}_change") for c in ("nb_departing", "nb_arriving")])
    return changes.where((F.col("nb_departing_change") != 0) | (F.col("nb_arriving_change") != 0))


def changed_congestion(congestion: DataFrame, changes: DataFrame) -> DataFrame:
    """New counts of exactly the airport-days that change; 0 and 0 where none is left."""
    before = congestion.select(*[F.col(c).alias(f"_{c}") for c in MOVEMENT], "nb_departing", "nb_arriving")
    same = F.lit(True)
    for name in MOVEMENT:
        same &= F.col(name).eqNullSafe(F.col(f"_{name}"))
    return changes.join(before, same, "left").select(
        *MOVEMENT, *[(F.coalesce(c, F.lit(0)) + F.col(f"{c}_change")).alias(c) for c in ("nb_departing", "nb_arriving")]
    )
