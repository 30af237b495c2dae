"""Read schemas of the landed JSON and the fixed column lists of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- Fixed values: field names of the flight-status format ----

PLACES_BOTH = [
    "aerogareCode",
    "gateNumber",
    "parkingPosition",
    "parkingPositionCustomStatus",
    "parkingPositionType",
    "pierCode",
    "terminalCode",
]
PLACES_DEPARTURE = [
    "boardingContactType",
    "boardingPier",
    "boardingTerminal",
    "checkInAerogare",
    "checkInZone",
    "departureTerminal",
    "paxDepartureGate",
]
PLACES_ARRIVAL = [
    "arrivalHall",
    "arrivalPositionPier",
    "arrivalPositionTerminal",
    "arrivalTerminal",
    "baggageBelt",
    "disembarkingAerogare",
    "disembarkingBusQuantity",
    "disembarkingContactType",
    "expectedBagOnBeltTime",
    "firstBagOnBeltTime",
    "lastBagOnBeltTime",
]
TIMES_BOTH = ["actual", "latestPublished", "modified", "scheduled"]
TIMES_DEPARTURE = ["actualTakeOffTime", "estimatedPublic", "estimatedTakeOffTime"]
TIMES_ARRIVAL = ["actualTouchDownTime", "estimatedArrival", "estimatedTouchDownTime"]
BOARDING_TIMES = ["actualBoardingOpen", "firstPaxBoarding", "gateCloseTime", "plannedBoardingTime"]
LEG_STRINGS = [
    "publishedStatus",
    "legStatusPublic",
    "legStatusPublicLangTransl",
    "statusName",
    "passengerCustomsStatus",
    "serviceType",
    "serviceTypeName",
    "restricted",
    "scheduledFlightDuration",
    "departureDateTimeDifference",
    "arrivalDateTimeDifference",
    "timeToArrival",
    "completionPercentage",
    "timeZoneDifference",
]
AIRCRAFT_STRINGS = [
    "typeCode",
    "typeName",
    "ownerAirlineCode",
    "physicalPaxConfiguration",
    "physicalFreightConfiguration",
    "operationalConfiguration",
    "cockpitCrewEmployer",
    "cabinCrewEmployer",
    "registration",
    "saleableConfiguration",
    "subFleetCodeId",
]
COUNTRY_STRINGS = ["code", "name", "euroCountry", "euCountry", "areaCode"]

# ---- End of the field names ----


def _strings(names: list[str]) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _struct(*fields: T.StructField) -> T.StructType:
    return T.StructType(list(fields))


CODE_NAME = _struct(*_strings(["code", "name"]))


def _airport(places: list[str]) -> T.StructType:
    city = _struct(*_strings(["code", "name"]), T.StructField("country", _struct(*_strings(COUNTRY_STRINGS))))
    location = _struct(T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()))
    return _struct(
        *_strings(["code", "name"]),
        T.StructField("location", location),
        T.StructField("city", city),
        T.StructField("places", _struct(*_strings(places))),
    )


DEPARTURE = _struct(
    T.StructField("airport", _airport(PLACES_BOTH + PLACES_DEPARTURE)),
    T.StructField("times", _struct(*_strings(TIMES_BOTH + TIMES_DEPARTURE))),
    T.StructField("boardingTimes", _struct(*_strings(BOARDING_TIMES))),
)
ARRIVAL = _struct(
    T.StructField("airport", _airport(PLACES_BOTH + PLACES_ARRIVAL)),
    T.StructField(
        "times",
        _struct(
            *_strings(TIMES_BOTH + TIMES_ARRIVAL),
            T.StructField("estimated", _struct(*_strings(["value"]))),
        ),
    ),
)
DELAY_ENTRY = _struct(*_strings(["delayCode", "delayDuration"]))
IRREGULARITY = _struct(
    *_strings(["cancelled"]),
    T.StructField("delayInformation", T.ArrayType(DELAY_ENTRY)),
    *[
        T.StructField(name, T.ArrayType(T.StringType()))
        for name in ["delayCode", "delayDuration", "delayReasonCodePublic", "delayReasonPublicLangTransl"]
    ],
    *_strings(["cancellationReasonCodePublic", "cancellationReasonPublicShort", "cancellationReasonPublicLong"]),
)
LEG = _struct(
    *_strings(LEG_STRINGS),
    T.StructField("aircraft", _struct(*_strings(AIRCRAFT_STRINGS))),
    T.StructField("departureInformation", DEPARTURE),
    T.StructField("arrivalInformation", ARRIVAL),
    T.StructField("irregularity", IRREGULARITY),
)
RELATED = _struct(*_strings(["id"]))
FLIGHT = _struct(
    *_strings(["id"]),
    T.StructField("flightNumber", T.IntegerType()),
    *_strings(["flightScheduleDate", "haul"]),
    T.StructField("route", T.ArrayType(T.StringType())),
    *_strings(["flightStatusPublic"]),
    T.StructField("airline", CODE_NAME),
    T.StructField(
        "codeShareRelations",
        T.ArrayType(_struct(*_strings(["marketingFlightNumber"]), T.StructField("airline", CODE_NAME))),
    ),
    T.StructField(
        "flightRelations",
        _struct(
            T.StructField("previousFlightData", RELATED),
            T.StructField("equivalentFlightData", RELATED),
            T.StructField("onwardFlightData", RELATED),
        ),
    ),
    T.StructField("flightLegs", T.ArrayType(LEG)),
)
PAGE = _struct(
    T.StructField("page", _struct(T.StructField("totalPages", T.IntegerType()))),
    T.StructField("fetchedAt", T.StringType()),
    T.StructField("operationalFlights", T.ArrayType(FLIGHT)),
)

SCHEDULE = _struct(
    *_strings(
        [
            "airline_iata",
            "flight_iata",
            "flight_number",
            "dep_iata",
            "dep_time",
            "dep_time_utc",
            "dep_estimated",
            "dep_actual",
            "arr_iata",
            "arr_time",
            "arr_time_utc",
            "arr_estimated",
            "arr_actual",
            "status",
        ]
    ),
    T.StructField("duration", T.IntegerType()),
    T.StructField("dep_delayed", T.IntegerType()),
    T.StructField("arr_delayed", T.IntegerType()),
)
AIRPORT_LISTING = _struct(
    *_strings(["name", "iata_code", "icao_code"]),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lng", T.DoubleType()),
    *_strings(["country_code", "city", "timezone"]),
    T.StructField("runways", T.IntegerType()),
    T.StructField("is_international", T.IntegerType()),
)
SCHEDULE_PAGE = _struct(T.StructField("response", T.ArrayType(SCHEDULE)))
AIRPORT_PAGE = _struct(T.StructField("response", T.ArrayType(AIRPORT_LISTING)))
