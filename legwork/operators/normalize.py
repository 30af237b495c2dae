"""Flight documents to flights, legs and delays."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwork.functions.keys import delay_id, leg_id
from legwork.functions.values import delay_entries, is_yes


def path_type(schema: T.DataType, path: str) -> T.DataType | None:
    """Type at a dotted path, or None where the path is absent."""
    for name in path.split("."):
        if not isinstance(schema, T.StructType) or name not in schema.fieldNames():
            return None
        schema = schema[name].dataType
    return schema


def field_or_null(df: DataFrame, path: str, kind: str = "string") -> Column:
    """The column at a path; a typed null where the input lacks it."""
    return F.col(path) if path_type(df.schema, path) is not None else F.lit(None).cast(kind)


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add each absent column as nulls of its type."""
    absent = {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs to top-level columns with dotted names; arrays stay as they are."""

    def leaves(schema: T.StructType, prefix: list[str]) -> list[Column]:
        found = []
        for field in schema.fields:
            path = [*prefix, field.name]
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType, path)
            else:
                found.append(F.col(".".join(f"`{p}`" for p in path)).alias(".".join(path)))
        return found

    return df.select(*leaves(df.schema, []))


def explode_child(df: DataFrame, array: str, keep: list[str], name: str = "item") -> DataFrame:
    """One row per array entry with its position and the parent's columns; no row for an empty array."""
    return df.select(*keep, F.posexplode(array).alias("position", name))


def leg_fields(docs: DataFrame, paths: dict[str, str], keep: dict[str, Column], kinds: dict[str, str] | None = None) -> DataFrame:
    """One row per leg with its position and the chosen leaves of the leg.

    ``paths`` maps column names to paths inside a leg, and ``keep`` names columns
    of the document. Each leaf is taken out of the leg array before the array is
    exploded, as only then does a parquet scan read just these leaves. A path
    that the input lacks gives nulls of the type in ``kinds``, else strings.
    """
    leg = docs.schema["flightLegs"].dataType.elementType
    found = [name for name, path in paths.items() if path_type(leg, path) is not None]
    leaves = [F.col(f"flightLegs.{paths[name]}").alias(f"leaf{i}") for i, name in enumerate(found)]
    parts = docs.select(*[column.alias(name) for name, column in keep.items()], *leaves)
    zipped = F.arrays_zip(*[f"leaf{i}" for i in range(len(found))])
    exploded = parts.select(*keep, F.posexplode(zipped).alias("position", "leg"))
    columns = {name: F.col(f"leg.leaf{i}") for i, name in enumerate(found)}
    nulls = {name: F.lit(None).cast((kinds or {}).get(name, "string")) for name in paths if name not in columns}
    return exploded.select(*keep, "position", *[(columns | nulls)[name].alias(name) for name in paths])


def flights(docs: DataFrame) -> DataFrame:
    return docs.select(
        "id",
        F.col("flightNumber").alias("flight_number"),
        F.col("flightScheduleDate").alias("flight_schedule_date"),
        F.col("airline.code").alias("airline_code"),
        F.col("airline.name").alias("airline_name"),
        "haul",
        "route",
        F.col("flightStatusPublic").alias("flight_status_public"),
        "fetched_at",
        *(["version"] if "version" in docs.columns else []),
    )


# Column of the leg table and its path inside a leg
LEG_PATHS = {
    "departure_airport_code": "departureInformation.airport.code",
    "arrival_airport_code": "arrivalInformation.airport.code",
    "published_status": "publishedStatus",
    "scheduled_departure": "departureInformation.times.scheduled",
    "actual_departure": "departureInformation.times.actual",
    "scheduled_arrival": "arrivalInformation.times.scheduled",
    "actual_arrival": "arrivalInformation.times.actual",
    "scheduled_flight_duration": "scheduledFlightDuration",
    "cancelled": "irregularity.cancelled",
    "aircraft_type_code": "aircraft.typeCode",
}
DELAY_PATHS = {
    "delayInformation": "irregularity.delayInformation",
    "delayCode": "irregularity.delayCode",
    "delayDuration": "irregularity.delayDuration",
}
DELAY_KINDS = {
    "delayInformation": "array<struct<delayCode:string,delayDuration:string>>",
    "delayCode": "array<string>",
    "delayDuration": "array<string>",
}


def entries_of_row() -> Column:
    """Delay entries from the columns of ``DELAY_PATHS``."""
    return delay_entries({name: F.col(name) for name in DELAY_PATHS})


def legs(docs: DataFrame) -> DataFrame:
    """One row per leg; a flight whose leg list is empty or null gives none."""
    rows = leg_fields(docs, LEG_PATHS, {"flight_id": F.col("id")})
    return rows.select(
        leg_id(F.col("flight_id"), F.col("position")).alias("id"),
        "flight_id",
        F.col("position").alias("leg_order"),
        *[is_yes(F.col(name)).alias(name) if name == "cancelled" else F.col(name) for name in LEG_PATHS],
    )


def delays(docs: DataFrame, linked: bool = False, positioned: bool = False) -> DataFrame:
    """One row per delay code of a leg.

    ``linked`` also keeps the flight id, and ``positioned`` the place of the code in its leg.
    """
    rows = leg_fields(docs, DELAY_PATHS, {"flight_id": F.col("id")}, DELAY_KINDS)
    entries = rows.select("flight_id", "position", F.posexplode(entries_of_row()).alias("delay_order", "entry"))
    return entries.select(
        delay_id(F.col("flight_id"), F.col("position"), F.col("delay_order")).alias("id"),
        leg_id(F.col("flight_id"), F.col("position")).alias("flight_leg_id"),
        F.col("entry.delayCode").alias("delay_code"),
        F.col("entry.delayDuration").alias("delay_duration"),
        *(["delay_order"] if positioned else []),
        *(["flight_id"] if linked else []),
    )


def route_stops(docs: DataFrame) -> DataFrame:
    """The route as a child table, one row per airport in order."""
    return docs.select(F.col("id").alias("flight_id"), F.posexplode("route").alias("position", "airport_code"))


def fan_out(docs: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Three tables from one read of the documents.

    Returns the persisted input, which the caller releases after writing.
    """
    shared = docs.persist(StorageLevel.MEMORY_AND_DISK)
    return shared, {"flights": flights(shared), "legs": legs(shared), "delays": delays(shared, linked=True)}


def legs_with_flights(legs_: DataFrame, flights_: DataFrame) -> DataFrame:
    """Every leg with its flight's columns; nulls where the flight is not loaded."""
    known = [F.col(name) for name in flights_.columns if name != "id" and name not in legs_.columns]
    return legs_.join(flights_.select(F.col("id").alias("flight_id"), *known), "flight_id", "left")
