"""The fourteen-entity relational model of flight documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwork.functions.keys import pair_key, plus_key
from legwork.functions.values import first_or
from legwork.operators.normalize import explode_child, field_or_null, leg_fields

# ---- Fixed values: source path and column name of each entity ----

LEG_FIELDS = [
    ("legStatusPublicLangTransl", "legStatus"),
    ("statusName", "status"),
    ("passengerCustomsStatus", "passengerCustomStatus"),
    ("serviceType", "serviceType"),
    ("serviceTypeName", "serviceTypeName"),
    ("restricted", "restricted"),
    ("scheduledFlightDuration", "scheduledFlightDuration"),
    ("departureDateTimeDifference", "departureDateTimeDifference"),
    ("arrivalDateTimeDifference", "arrivalDateTimeDifference"),
    ("timeToArrival", "timeToArrival"),
    ("completionPercentage", "completionPercentage"),
    ("timeZoneDifference", "timeZoneDifference"),
    ("aircraft.typeCode", "aircraftCode"),
]
DEPARTURE_FIELDS = [
    ("airport.places.aerogareCode", "departureAerogareCode"),
    ("airport.places.gateNumber", "departureGateNumber"),
    ("airport.places.parkingPosition", "departureParkingPosition"),
    ("airport.places.parkingPositionCustomStatus", "departureParkingPositionCustomStatus"),
    ("airport.places.parkingPositionType", "departureParkingPositionType"),
    ("airport.places.pierCode", "departurePierCode"),
    ("airport.places.terminalCode", "departureTerminalCode"),
    ("airport.code", "departureAirportCode"),
    ("times.actual", "departureActualTime"),
    ("times.latestPublished", "departureLatestPublishedTime"),
    ("times.modified", "departureModifiedTime"),
    ("times.scheduled", "departureScheduledTime"),
    ("airport.places.boardingContactType", "departureBoardingContactType"),
    ("airport.places.boardingPier", "departureBoardingPier"),
    ("airport.places.boardingTerminal", "departureBoardingTerminal"),
    ("airport.places.checkInAerogare", "departureCheckInAerogare"),
    ("airport.places.checkInZone", "departureCheckInZone"),
    ("airport.places.departureTerminal", "departureTerminal"),
    ("airport.places.paxDepartureGate", "departurePaxDepartureGate"),
    ("boardingTimes.actualBoardingOpen", "departureActualBoardingOpen"),
    ("boardingTimes.firstPaxBoarding", "departureFirstPaxBoarding"),
    ("boardingTimes.gateCloseTime", "departureGateCloseTime"),
    ("boardingTimes.plannedBoardingTime", "departurePlannedBoardingTime"),
    ("times.actualTakeOffTime", "departureActualTakeOffTime"),
    ("times.estimatedPublic", "departureEstimatedPublic"),
    ("times.estimatedTakeOffTime", "departureEstimatedTakeOffTime"),
]
ARRIVAL_FIELDS = [
    ("airport.places.aerogareCode", "arrivalAerogareCode"),
    ("airport.places.gateNumber", "arrivalGateNumber"),
    ("airport.places.parkingPosition", "arrivalParkingPosition"),
    ("airport.places.parkingPositionCustomStatus", "arrivalParkingPositionCustomStatus"),
    ("airport.places.parkingPositionType", "arrivalParkingPositionType"),
    ("airport.places.pierCode", "arrivalPierCode"),
    ("airport.places.terminalCode", "arrivalTerminalCode"),
    ("airport.code", "arrivalAirportCode"),
    ("times.actual", "arrivalActualTime"),
    ("times.latestPublished", "arrivalLatestPublishedTime"),
    ("times.modified", "arrivalModifiedTime"),
    ("times.scheduled", "arrivalScheduledTime"),
    ("airport.places.arrivalHall", "arrivalHall"),
    ("airport.places.arrivalPositionPier", "arrivalPositionPier"),
    ("airport.places.arrivalPositionTerminal", "arrivalPositionTerminal"),
    ("airport.places.arrivalTerminal", "arrivalTerminal"),
    ("airport.places.baggageBelt", "arrivalBaggageBelt"),
    ("airport.places.disembarkingAerogare", "arrivalDisembarkingAerogare"),
    ("airport.places.disembarkingBusQuantity", "arrivalDisembarkingBusQuantity"),
    ("airport.places.disembarkingContactType", "arrivalDisembarkingContactType"),
    ("airport.places.expectedBagOnBeltTime", "arrivalExpectedBagOnBeltTime"),
    ("airport.places.firstBagOnBeltTime", "arrivalFirstBagOnBeltTime"),
    ("airport.places.lastBagOnBeltTime", "arrivalLastBagOnBeltTime"),
    ("times.actualTouchDownTime", "arrivalActualTouchDownTime"),
    ("times.estimated.value", "arrivalEstimated"),
    ("times.estimatedArrival", "arrivalEstimatedArrival"),
    ("times.estimatedTouchDownTime", "arrivalEstimatedTouchDownTime"),
]
AIRPORT_FIELDS = [
    ("airport.code", "airportCode"),
    ("airport.name", "airportName"),
    ("airport.location.latitude", "latitude"),
    ("airport.location.longitude", "longitude"),
    ("airport.city.code", "cityCode"),
]
CITY_FIELDS = [
    ("airport.city.code", "cityCode"),
    ("airport.city.name", "cityName"),
    ("airport.city.country.code", "countryCode"),
]
COUNTRY_FIELDS = [
    ("airport.city.country.code", "countryCode"),
    ("airport.city.country.name", "countryName"),
    ("airport.city.country.euroCountry", "euroCountry"),
    ("airport.city.country.euCountry", "euCountry"),
    ("airport.city.country.areaCode", "areaCode"),
]
AIRCRAFT_FIELDS = [
    ("typeCode", "aircraftCode"),
    ("typeName", "aircraftName"),
    ("ownerAirlineCode", "ownerAirlineCode"),
    ("physicalPaxConfiguration", "physicalPaxConfiguration"),
    ("physicalFreightConfiguration", "physicalFreightConfiguration"),
    ("operationalConfiguration", "operationalConfiguration"),
    ("cockpitCrewEmployer", "cockpitCrewEmployerCode"),
    ("cabinCrewEmployer", "cabinCrewEmployerCode"),
    ("registration", "registration"),
    ("saleableConfiguration", "saleableConfiguration"),
    ("subFleetCodeId", "subFleetCodeId"),
    ("typeCode", "typeCode"),
    ("typeName", "typeName"),
]
CANCEL_FIELDS = [
    ("cancellationReasonCodePublic", "cancellationReasonCode"),
    ("cancellationReasonPublicShort", "cancellationReasonShort"),
    ("cancellationReasonPublicLong", "cancellationReasonLong"),
]
FIRST_ENTRY_DEFAULTS = {
    "delayCode": "",
    "delayDuration": "00",
    "delayReasonCodePublic": "",
    "delayReasonPublicLangTransl": "",
}
RELATION_KINDS = ["previous", "equivalent", "onward"]

# ---- End of the fixed values ----


def _flight_key(airline_code: str, number: str) -> Column:
    return plus_key(F.col(airline_code), F.col(number).cast("string"))


def scheduled_flights(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("id").alias("scheduledFlightId"),
        "flightNumber",
        "flightScheduleDate",
        "haul",
        "route",
        "flightStatusPublic",
        F.col("airline.code").alias("airlineCode"),
    )


def operating_flights(docs: DataFrame) -> DataFrame:
    """Flights by carrier and number."""
    return docs.select(
        _flight_key("airline.code", "flightNumber").alias("flightId"),
        F.col("flightNumber").cast("string").alias("flightNumber"),
        F.col("airline.code").alias("airlineCode"),
    ).distinct()


def airlines(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("airline.code").alias("airlineCode"), F.col("airline.name").alias("airlineName")
    ).distinct()


def _code_shares(docs: DataFrame) -> DataFrame:
    flights = docs.withColumn("flightId", _flight_key("airline.code", "flightNumber"))
    return (
        explode_child(flights, "codeShareRelations", ["flightId"], "share")
        .select(
            "flightId",
            F.col("share.marketingFlightNumber").try_cast("int").cast("string").alias("marketingFlightNumber"),
            F.col("share.airline.code").alias("airlineCode"),
        )
        .where(F.col("marketingFlightNumber").isNotNull())
        .withColumn("relatedFlightId", plus_key(F.col("airlineCode"), F.col("marketingFlightNumber")))
    )


def code_share_relations(docs: DataFrame) -> DataFrame:
    """Pairs of flights sold together; both directions share one id."""
    return _code_shares(docs).select(
        pair_key(F.col("flightId"), F.col("relatedFlightId")).alias("codeShareId"), "flightId", "relatedFlightId"
    )


def code_share_flights(docs: DataFrame) -> DataFrame:
    """The marketing side of code shares, as flights."""
    return (
        _code_shares(docs)
        .select(
            F.col("relatedFlightId").alias("flightId"), F.col("marketingFlightNumber").alias("flightNumber"), "airlineCode"
        )
        .distinct()
    )


def flight_relations(docs: DataFrame) -> DataFrame:
    """Previous, equivalent and onward flights of each scheduled flight, from one pass."""
    entries = F.array(
        *[
            F.struct(
                field_or_null(docs, f"flightRelations.{kind}FlightData.id").alias("relatedScheduledFlightId"),
                F.lit(kind).alias("relationType"),
            )
            for kind in RELATION_KINDS
        ]
    )
    return (
        docs.select(F.col("id").alias("scheduledFlightId"), F.explode(entries).alias("relation"))
        .select("scheduledFlightId", "relation.*")
        .where(F.col("relatedScheduledFlightId").isNotNull())
        .select(
            plus_key(F.col("relatedScheduledFlightId"), F.col("scheduledFlightId")).alias("flightRelationId"),
            "scheduledFlightId",
            "relatedScheduledFlightId",
            "relationType",
        )
    )


def prepared_legs(docs: DataFrame, paths: dict[str, str], kinds: dict[str, str] | None = None) -> DataFrame:
    """Legs with their key and the chosen leaves; legs without a full key are dropped."""
    codes = {"_departure": "departureInformation.airport.code", "_arrival": "arrivalInformation.airport.code"}
    rows = leg_fields(docs, codes | paths, {"scheduledFlightId": F.col("id")}, kinds)
    key = plus_key(F.col("scheduledFlightId"), F.col("_departure"), F.col("_arrival"))
    return rows.select(key.alias("flightLegId"), "scheduledFlightId", *paths).where(F.col("flightLegId").isNotNull())


def _below(prefix: str, fields: list[tuple[str, str]]) -> dict[str, str]:
    return {name: f"{prefix}.{path}" for path, name in fields}


def flight_legs(docs: DataFrame) -> DataFrame:
    """The wide leg table, 68 columns."""
    paths = {name: path for path, name in LEG_FIELDS}
    departure, arrival = _below("departureInformation", DEPARTURE_FIELDS), _below("arrivalInformation", ARRIVAL_FIELDS)
    return prepared_legs(docs, paths | departure | arrival)


def _both_ends(docs: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """Distinct rows over the departure and arrival side, from one pass over the legs."""
    sides = ("departureInformation", "arrivalInformation")
    paths = {f"{side}_{name}": f"{side}.{path}" for side in sides for path, name in fields}
    coordinates = {f"{side}_{name}": "double" for side in sides for name in ("latitude", "longitude")}
    ends = F.array(*[F.struct(*[F.col(f"{side}_{name}").alias(name) for _, name in fields]) for side in sides])
    return prepared_legs(docs, paths, coordinates).select(F.explode(ends).alias("end")).select("end.*").distinct()


def airports(docs: DataFrame) -> DataFrame:
    return _both_ends(docs, AIRPORT_FIELDS)


def cities(docs: DataFrame) -> DataFrame:
    return _both_ends(docs, CITY_FIELDS)


def countries(docs: DataFrame) -> DataFrame:
    return _both_ends(docs, COUNTRY_FIELDS)


def aircraft(docs: DataFrame) -> DataFrame:
    return prepared_legs(docs, _below("aircraft", AIRCRAFT_FIELDS)).drop("flightLegId", "scheduledFlightId").distinct()


def _first_entries(docs: DataFrame, names: list[str], others: dict[str, str] | None = None) -> DataFrame:
    """Legs with the first entry of each named list, or its default."""
    paths = {name: f"irregularity.{name}" for name in names}
    rows = prepared_legs(docs, paths | (others or {}), {name: "array<string>" for name in names})
    return rows.withColumns({name: first_or(F.col(name), FIRST_ENTRY_DEFAULTS[name]) for name in names})


def irregularities(docs: DataFrame) -> DataFrame:
    others = {
        "cancelled": "irregularity.cancelled",
        "cancellationReasonCode": "irregularity.cancellationReasonCodePublic",
    }
    return (
        _first_entries(docs, ["delayCode", "delayDuration"], others)
        .select("flightLegId", *others, "delayCode", "delayDuration")
        .distinct()
    )


def delay_codes(docs: DataFrame) -> DataFrame:
    return (
        _first_entries(docs, ["delayCode", "delayReasonCodePublic"])
        .select("delayCode", F.col("delayReasonCodePublic").alias("delayReasonCode"))
        .distinct()
    )


def delay_reasons(docs: DataFrame) -> DataFrame:
    return (
        _first_entries(docs, ["delayReasonCodePublic", "delayReasonPublicLangTransl"])
        .select(
            F.col("delayReasonCodePublic").alias("delayReasonCode"),
            F.col("delayReasonPublicLangTransl").alias("delayReason"),
        )
        .distinct()
    )


def cancel_reasons(docs: DataFrame) -> DataFrame:
    return prepared_legs(docs, _below("irregularity", CANCEL_FIELDS)).drop("flightLegId", "scheduledFlightId").distinct()


def legs_with_irregularity(legs: DataFrame, irregularity: DataFrame) -> DataFrame:
    """Plain left join; a leg with several irregularity rows appears once for each."""
    return legs.join(irregularity.select("flightLegId", "delayDuration"), "flightLegId", "left")


def airport_geography(airport: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    """Airport with its city and country."""
    return airport.join(city, "cityCode", "left").join(country, "countryCode", "left")


def leg_aircraft_owner(legs: DataFrame, planes: DataFrame, carriers: DataFrame) -> DataFrame:
    """Legs with the type of their aircraft and the airlines that own such aircraft."""
    owners = planes.where(F.col("aircraftCode").isNotNull()).select("aircraftCode", "aircraftName", "ownerAirlineCode")
    named = owners.distinct().join(
        carriers.select(F.col("airlineCode").alias("ownerAirlineCode"), F.col("airlineName").alias("ownerAirlineName")),
        "ownerAirlineCode",
        "left",
    )
    return legs.select("flightLegId", "aircraftCode").join(named, "aircraftCode", "left")


def related_flights(relations: DataFrame, flights: DataFrame) -> DataFrame:
    """Relations with the scheduled flights on both sides; a flight that is not loaded drops its relation."""

    def side(key: str, name: str) -> DataFrame:
        return flights.select(
            F.col("scheduledFlightId").alias(key),
            F.col("flightScheduleDate").alias(f"{name}ScheduleDate"),
            F.col("airlineCode").alias(f"{name}AirlineCode"),
        )

    return relations.join(side("scheduledFlightId", "flight"), "scheduledFlightId").join(
        side("relatedScheduledFlightId", "related"), "relatedScheduledFlightId"
    )


def all_entities(docs: DataFrame) -> dict[str, DataFrame]:
    """Every table of the model by name."""
    flights = reduce(DataFrame.unionByName, [operating_flights(docs), code_share_flights(docs)])
    return {
        "scheduledFlight": scheduled_flights(docs),
        "flight": flights,
        "airline": airlines(docs),
        "codeShareRelation": code_share_relations(docs),
        "flightRelation": flight_relations(docs),
        "flightLeg": flight_legs(docs),
        "airport": airports(docs),
        "city": cities(docs),
        "country": countries(docs),
        "aircraft": aircraft(docs),
        "irregularity": irregularities(docs),
        "delay": delay_codes(docs),
        "delayReason": delay_reasons(docs),
        "cancelReason": cancel_reasons(docs),
    }
