"""Flight documents derived from the order tables.

An order is a flight, its lines are legs, the supplier's and the customer's
nation are the airports, and the market segment is the carrier. ``FIXTURES.md``
gives the rules; ``oracle.py`` states them again in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.operators.merge import latest_by_key

#: Setting under which documents are written: sorted rows are grouped without a hash table.
SORTED = ("spark.sql.execution.replaceHashWithSortAgg", "true")
RUN_TS = "2026-02-01 00:00:00"
FIRST_DAY = "2026-01-01"
LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def _airport_code(nation: Column) -> Column:
    return F.concat(F.lit("N"), _padded(nation, 2))


def _day(date: Column, minutes: Column) -> Column:
    return F.date_add(date, F.floor(minutes / 1440).cast("int"))


def _stamp(date: Column, minutes: Column, offset: Column) -> Column:
    """ISO text of a local time given as minutes after midnight of a date."""
    moment = F.timestamp_add("MINUTE", minutes, date.cast("timestamp"))
    sign = F.when(offset < 0, "-").otherwise("+")
    return F.concat(
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS"), sign, _padded(F.abs(offset), 2), F.lit(":00")
    )


def flight_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the scalar fields of its flight."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    key = F.col("o_orderkey")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (key % 31).cast("int"))
    carrier = F.substring("c_mktsegment", 1, 2)
    number = F.when(key < 1000, _padded(key, 4)).otherwise(key.cast("string"))
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        key.alias("ok"),
        F.concat(F.date_format(day, "yyyyMMdd"), F.lit("+"), carrier, F.lit("+"), number).alias("flight_id"),
        (key % 500 + 1).cast("int").alias("flight_number"),
        day.alias("flight_schedule_date"),
        carrier.alias("airline_code"),
        F.col("c_mktsegment").alias("airline_name"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "LONG")
        .when(F.col("o_orderpriority") == "2-HIGH", "MEDIUM")
        .otherwise("SHORT")
        .alias("haul"),
        F.when(F.col("o_orderstatus") == "F", "ARRIVED")
        .when(F.col("o_orderstatus") == "O", "ON_TIME")
        .otherwise("DELAYED")
        .alias("flight_status_public"),
        F.col("c_nationkey").alias("arr_nation"),
    )


def leg_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; (order, line number) repeats, as if a leg had been loaded several times."""
    return table(spark, sf_dir, "lineitem")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of each line, so at most one row per order and line number."""
    return latest_by_key(
        leg_versions(spark, sf_dir), ["l_orderkey", "l_linenumber"], [F.desc(c) for c in LINE_ORDER]
    )


def leg_base(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """One row per leg with its plain fields, before it is nested into its flight.

    ``together`` puts the legs of an order into one task, however its flight is joined.
    """
    supplier, part = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    supplied = (
        lines(spark, sf_dir)
        .join(supplier.select("s_suppkey", F.col("s_nationkey").alias("dep_nation")), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part.select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    )
    if together:
        supplied = supplied.repartition("l_orderkey")
    joined = supplied.join(flight_base(spark, sf_dir), F.col("l_orderkey") == F.col("ok"))
    line, quantity = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    minute = (F.col("l_partkey") * 7 + line * 60) % 1440
    length = 45 + (F.col("l_suppkey") * 13 + line * 7) % 600
    dep_offset, arr_offset = F.col("dep_nation") - 12, F.col("arr_nation") - 12
    landing = minute - dep_offset * 60 + length + arr_offset * 60
    late = F.round(F.col("l_discount") * 100).cast("int") * 3 - 6
    late_arrival = late + F.round(F.col("l_tax") * 100).cast("int") - 4
    day = F.col("flight_schedule_date")
    flown = F.col("ok") % 17 != 0
    hours, minutes = F.floor(length / 60), length % 60
    planned = F.concat(
        F.lit("PT"),
        F.when(hours > 0, F.concat(hours.cast("string"), F.lit("H"))).otherwise(""),
        F.when(minutes > 0, F.concat(minutes.cast("string"), F.lit("M"))).otherwise(""),
    )
    return joined.select(
        "ok",
        "l_linenumber",
        "flight_id",
        "flight_number",
        "flight_schedule_date",
        "airline_code",
        "airline_name",
        _airport_code(F.col("dep_nation")).alias("departure_airport_code"),
        _airport_code(F.col("arr_nation")).alias("arrival_airport_code"),
        "dep_nation",
        "arr_nation",
        F.when(F.col("l_linestatus") == "F", "ARRIVED").otherwise("ON_TIME").alias("published_status"),
        _stamp(day, minute, dep_offset).alias("scheduled_departure"),
        F.when(flown, _stamp(day, minute + late, dep_offset)).alias("actual_departure"),
        _stamp(day, landing, arr_offset).alias("scheduled_arrival"),
        F.when(flown, _stamp(day, landing + late_arrival, arr_offset)).alias("actual_arrival"),
        _day(day, landing).alias("arrival_date"),
        F.concat(F.lit("PT"), late.cast("string"), F.lit("M")).alias("departure_difference"),
        F.when(F.col("l_partkey") % 41 != 0, planned).alias("scheduled_flight_duration"),
        F.when((F.col("l_returnflag") == "A") & (F.col("l_partkey") % 11 == 0), "Y").otherwise("N").alias("cancelled"),
        (F.col("l_suppkey") % 13 != 0).alias("has_irregularity"),
        F.when(F.col("l_partkey") % 29 != 0, F.substring("p_type", 1, 3)).alias("aircraft_type_code"),
        "p_type",
        "p_brand",
        quantity.alias("quantity"),
        _padded(F.col("l_partkey") % 40, 2).alias("first_code"),
        _padded(F.col("l_suppkey") % 40 + 50, 2).alias("second_code"),
    )


def flat_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legs with a key, for operators that start from tables."""
    return leg_base(spark, sf_dir).withColumn(
        "leg_id", F.concat("flight_id", F.lit("_"), F.col("l_linenumber").cast("string"))
    )


def delay_minutes() -> Column:
    """All delay minutes of a flat leg."""
    first = F.greatest(F.col("quantity") - 30, F.lit(0))
    second = F.greatest(F.col("quantity") - 45, F.lit(0))
    return F.when(F.col("has_irregularity"), first + second).otherwise(0)


def _side(code: str, nation: str, scheduled: str, actual: str, leg: dict[str, Column]) -> Column:
    key = leg[nation]
    region = key % 5
    return F.struct(
        F.struct(
            leg[code].alias("code"),
            F.concat(F.lit("AIRPORT "), key.cast("string")).alias("name"),
            F.struct((key * 3 - 30).cast("double").alias("latitude"), (key * 7 - 80).cast("double").alias("longitude")).alias(
                "location"
            ),
            F.struct(
                F.concat(F.lit("C"), _padded(key % 10, 2)).alias("code"),
                F.concat(F.lit("CITY "), (key % 10).cast("string")).alias("name"),
                F.struct(
                    F.concat(F.lit("R"), region.cast("string")).alias("code"),
                    F.concat(F.lit("COUNTRY "), region.cast("string")).alias("name"),
                    F.when(region == 3, "Y").otherwise("N").alias("euroCountry"),
                    F.when(region >= 3, "Y").otherwise("N").alias("euCountry"),
                    F.concat(F.lit("A"), (region % 2).cast("string")).alias("areaCode"),
                ).alias("country"),
            ).alias("city"),
            F.struct(F.concat(F.lit("G"), (leg["quantity"] % 20).cast("string")).alias("gateNumber")).alias("places"),
        ).alias("airport"),
        F.struct(leg[scheduled].alias("scheduled"), leg[actual].alias("actual")).alias("times"),
    )


def _irregularity(leg: dict[str, Column]) -> Column:
    late = leg["quantity"] > 30
    twice = leg["quantity"] > 45
    first = _padded(leg["quantity"] - 30, 4)
    second = _padded(leg["quantity"] - 45, 4)
    text = F.lit(None).cast("array<string>")
    one = F.struct(leg["first_code"].alias("delayCode"), first.alias("delayDuration"))
    two = F.struct(leg["second_code"].alias("delayCode"), second.alias("delayDuration"))
    entries = F.when(twice, F.array(one, two)).when(late, F.array(one)).otherwise(F.slice(F.array(one), 1, 0))
    reason = F.when(late, F.array(F.concat(F.lit("R"), leg["first_code"])))
    return F.when(
        leg["has_irregularity"],
        F.struct(
            leg["cancelled"].alias("cancelled"),
            F.when(leg["l_linenumber"] % 2 == 1, entries).alias("delayInformation"),
            F.when(late, F.array(leg["first_code"], leg["second_code"])).otherwise(text).alias("delayCode"),
            F.when(twice, F.array(first, second)).when(late, F.array(first)).otherwise(text).alias("delayDuration"),
            reason.alias("delayReasonCodePublic"),
            F.transform(reason, lambda r: F.concat(F.lit("Reason "), r)).alias("delayReasonPublicLangTransl"),
            F.when(leg["cancelled"] == "Y", "X1").alias("cancellationReasonCodePublic"),
            F.when(leg["cancelled"] == "Y", "Short X1").alias("cancellationReasonPublicShort"),
            F.when(leg["cancelled"] == "Y", "Long X1").alias("cancellationReasonPublicLong"),
        ),
    )


def _document_leg(leg: dict[str, Column]) -> Column:
    return F.struct(
        leg["published_status"].alias("publishedStatus"),
        leg["scheduled_flight_duration"].alias("scheduledFlightDuration"),
        leg["departure_difference"].alias("departureDateTimeDifference"),
        F.when(
            leg["aircraft_type_code"].isNotNull(),
            F.struct(
                leg["aircraft_type_code"].alias("typeCode"),
                leg["p_type"].alias("typeName"),
                leg["airline_code"].alias("ownerAirlineCode"),
                leg["p_brand"].alias("registration"),
            ),
        ).alias("aircraft"),
        _side("departure_airport_code", "dep_nation", "scheduled_departure", "actual_departure", leg).alias(
            "departureInformation"
        ),
        _side("arrival_airport_code", "arr_nation", "scheduled_arrival", "actual_arrival", leg).alias("arrivalInformation"),
        _irregularity(leg).alias("irregularity"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested flight documents. An order without lines has no leg array.

    Lines are nested per order after repeated versions were merged away, so an
    order brings at most one entry per line number (1 to 7) into its array. Rows
    of an order arrive together and in order, so ``SORTED`` nests them as they come.
    """
    # Whole legs are built after the sort and stay in their order: wide rows are neither sorted nor kept.
    legs = leg_base(spark, sf_dir, together=True).sortWithinPartitions("ok")
    place = ["l_linenumber", "airline_code", "departure_airport_code", "arrival_airport_code"]
    placed = legs.select("ok", F.struct(*place, _document_leg({c: F.col(c) for c in legs.columns}).alias("leg")).alias("line"))
    nested = placed.groupBy("ok").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    flights = flight_base(spark, sf_dir)
    ids = flights.select(F.col("ok").alias("related_key"), F.col("flight_id").alias("related_id"))
    kind = F.col("ok") % 4
    # A flight without a relation gets a key of its own, so that these rows spread out.
    related_key = (
        F.when(kind == 1, F.col("ok") - 1).when(kind == 0, F.col("ok") + 1).when(kind == 2, F.col("ok") + 4)
    )
    keyed = flights.withColumn("related_key", F.coalesce(related_key, -F.col("ok") - 1))
    joined = keyed.join(ids, "related_key", "left").join(nested, "ok", "left")
    share_number = _padded(F.col("ok") % 900 + 1, 4)

    def share(number: Column, carrier: str) -> Column:
        return F.struct(
            number.alias("marketingFlightNumber"),
            F.struct(F.lit(carrier).alias("code"), F.lit(f"{carrier} PARTNER").alias("name")).alias("airline"),
        )

    first, second = share(share_number, "XA"), share(F.when(F.col("ok") % 5 != 0, share_number), "XB")

    def relation(wanted: int, name: str) -> Column:
        present = (kind == wanted) & F.col("related_id").isNotNull()
        return F.when(present, F.struct(F.col("related_id").alias("id"))).alias(name)

    return joined.select(
        F.col("flight_id").alias("id"),
        F.col("flight_number").alias("flightNumber"),
        F.col("flight_schedule_date").cast("string").alias("flightScheduleDate"),
        "haul",
        F.when(
            F.col("lines").isNotNull(),
            F.concat(
                F.transform(F.slice("lines", 1, 1), lambda leg: leg["departure_airport_code"]),
                F.transform("lines", lambda leg: leg["arrival_airport_code"]),
            ),
        ).alias("route"),
        F.col("flight_status_public").alias("flightStatusPublic"),
        F.struct(F.col("airline_code").alias("code"), F.col("airline_name").alias("name")).alias("airline"),
        F.when(F.col("ok") % 3 == 1, F.array(first))
        .when(F.col("ok") % 3 == 2, F.array(first, second))
        .alias("codeShareRelations"),
        F.struct(
            relation(1, "previousFlightData"), relation(2, "equivalentFlightData"), relation(0, "onwardFlightData")
        ).alias("flightRelations"),
        F.col("lines.leg").alias("flightLegs"),
        F.lit(RUN_TS).cast("timestamp").alias("fetched_at"),
    )
