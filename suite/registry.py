"""One query per operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.functions import calendar, durations, keys, values
from legwork.operators import congestion, entities, merge, normalize, quality, rankings, search
from legwork.plans import intermediate, mart, raw
from legwork.sources import documents as docsource
from legwork.session import work_dir
from legwork.sources import windows
from legwork.sources.tables import merge_into, read_table
from suite.fixture import delay_minutes, flat_legs, leg_versions, table
from suite.staging import landed_mart, raw_tables, staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def micros(name: str) -> Column:
    return F.unix_micros(name).alias(name)


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name), digits).alias(name)


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return staged(spark, sf, "documents")


# ---- documents and normalised tables ----


@query
def flights(spark, sf):
    return normalize.flights(_docs(spark, sf)).withColumns(
        {"route": F.array_join("route", ">"), "fetched_at": text("fetched_at")}
    )


@query
def legs(spark, sf):
    return normalize.legs(_docs(spark, sf))


@query
def delays(spark, sf):
    return normalize.delays(_docs(spark, sf))


@query
def legs_left_flights(spark, sf):
    """All legs with their flights, of which some are not loaded."""
    loaded = staged(spark, sf, "flights").where("flight_number % 7 <> 0")
    joined = normalize.legs_with_flights(staged(spark, sf, "legs"), loaded)
    return joined.select("id", "flight_id", "leg_order", "flight_number", "airline_code", "haul")


@query
def route_stops(spark, sf):
    return normalize.route_stops(_docs(spark, sf))


@query
def raw_upsert(spark, sf):
    """Whole documents after two loads: the second has new versions of some and late, older ones of others."""
    docs = _docs(spark, sf)
    old = docs.withColumns({"airline": F.lit(None).cast(docs.schema["airline"].dataType), "fetched_at": F.lit("2026-01-20").cast("timestamp")})
    even = F.col("flightNumber") % 2 == 0
    folder = f"{work_dir(spark)}/documents"
    order = [F.desc("fetched_at"), F.desc("payload")]
    for load in (docs.where(even).unionByName(old.where(~even)), docs.where(~even).unionByName(old.where(even))):
        merge_into(docsource.store_documents(load), folder, ["id"], order)
    return read_table(spark, folder).select(
        "id",
        "source",
        F.get_json_object("payload", "$.airline.code").alias("airline_code"),
        F.json_array_length(F.get_json_object("payload", "$.flightLegs")).alias("nb_legs"),
        text("fetched_at"),
    )


@query
def raw_documents(spark, sf):
    stored = docsource.store_documents(_docs(spark, sf))
    return raw.raw_documents(docsource.documents_from_payload(stored)).select(
        "flight_id",
        "flight_number",
        text("flight_schedule_date"),
        "haul",
        F.array_join("route", ">").alias("route"),
        "airline_code",
        "airline_name",
        "flight_status_public",
        "leg_order",
        "departure_airport_code",
        "arrival_airport_code",
        "leg_status",
        *[micros(c) for c in raw.LEG_TIMES],
        "scheduled_flight_duration",
        "cancelled",
        F.coalesce(F.size("delay_info"), F.lit(0)).alias("nb_delays"),
        text("fetched_at"),
    )


@query
def flattened(spark, sf):
    flat = normalize.flatten(_docs(spark, sf))
    return flat.select(
        *[F.col(f"`{c}`").alias(c.replace(".", "_")) for c in flat.columns if "." in c],
        "id",
    )


@query
def column_inventory(spark, sf):
    """Names of every leaf that occurs anywhere in the stored documents."""
    found = docsource.column_inventory(docsource.store_documents(_docs(spark, sf)))
    return found.select("column_name")


# ---- merges ----


@query
def merge_latest(spark, sf):
    newest = merge.latest_by_key(
        table(spark, sf, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]
    )
    return newest.select("user_id", "event_type", "event_id", _micros_ntz("ts"), "value")


@query
def merge_upsert(spark, sf):
    """Two loads merged through storage."""
    events = table(spark, sf, "events")
    order = [F.desc("ts"), F.desc("event_id")]
    key = ["user_id", "event_type"]
    folder = f"{work_dir(spark)}/events"
    for load in (events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")):
        merge_into(load, folder, key, order)
    return read_table(spark, folder).select("user_id", "event_type", "event_id", _micros_ntz("ts"), "value")


def _micros_ntz(name: str) -> Column:
    return F.unix_micros(F.col(name).cast("timestamp")).alias(name)


@query
def merge_composite(spark, sf):
    flat = flat_legs(spark, sf)
    staging = flat.select(
        F.concat("airline_code", F.col("flight_number").cast("string")).alias("flight_iata"),
        F.col("departure_airport_code").alias("dep_iata"),
        F.col("arrival_airport_code").alias("arr_iata"),
        F.col("published_status").alias("status"),
        F.when(F.col("scheduled_flight_duration").isNotNull(), calendar.instant(F.col("scheduled_departure"))).alias(
            "dep_time"
        ),
        calendar.instant(F.col("scheduled_arrival")).alias("arr_time"),
        F.timestamp_add("HOUR", F.col("quantity"), F.col("flight_schedule_date").cast("timestamp")).alias("ingested_at"),
    )
    return merge.silver_schedules(staging).withColumns(
        {c: F.unix_micros(c) for c in ("dep_time", "arr_time", "updated_at")}
    )


@query
def merge_airports(spark, sf):
    flat = flat_legs(spark, sf)
    staging = flat.select(
        F.col("departure_airport_code").alias("iata_code"),
        F.concat(F.lit("K"), "departure_airport_code").alias("icao_code"),
        F.concat(F.lit("AIRPORT "), F.col("quantity").cast("string")).alias("name"),
        F.col("dep_nation").cast("double").alias("lat"),
        F.col("quantity").cast("double").alias("lng"),
        F.lit("CITY").alias("city"),
        F.timestamp_add("HOUR", F.col("quantity"), F.col("flight_schedule_date").cast("timestamp")).alias("ingested_at"),
    )
    return merge.silver_airports(staging).withColumns(
        {c: F.unix_micros(c) for c in ("created_at", "last_updated_at")}
    )


@query
def merge_children(spark, sf):
    children = leg_versions(spark, sf)
    parents = children.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("l_shipdate"))
    current = merge.replace_children(children, parents, "l_orderkey", ["l_shipdate"])
    return current.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# ---- fetch planning ----


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").groupBy("event_type").agg(F.min(ts).alias("start"), F.max(ts).alias("end"))


@query
def window_plan(spark, sf):
    planned = windows.with_request_bounds(windows.window_plan(_spans(spark, sf)))
    return planned.select("event_type", micros("window_start"), micros("window_end"), "start_range", "end_range")


def _page_counts(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .groupBy("event_type", F.to_date("ts").cast("string").alias("day"))
        .agg(F.ceil(F.count(F.lit(1)) / 50).cast("int").alias("total_pages"))
    )


@query
def page_plan(spark, sf):
    return windows.page_plan(_page_counts(spark, sf))


@query
def missing_pages(spark, sf):
    plan = windows.page_plan(_page_counts(spark, sf))
    day = F.dayofmonth(F.col("day").cast("date"))
    landed = plan.where((F.col("page_number") + day) % 3 != 0)
    return windows.missing_pages(plan, landed, ["event_type", "day", "page_number"])


@query
def resolve_window(spark, sf):
    state = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("last_window_end"))
    now = "2024-02-01 00:00:00"
    runs = {
        "saved": windows.resolve_window(state, now, start="2024-01-05"),
        "fixed": windows.resolve_window(state, now, start="2024-01-05", end="2024-01-06", incremental=False),
        "fallback": windows.resolve_window(state, now, incremental=False),
    }
    named = [df.select(F.lit(name).alias("run"), micros("start"), micros("end")) for name, df in runs.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


# ---- checks and profiles ----


@query
def freshness(spark, sf):
    checked = quality.freshness(table(spark, sf, "events"), "2024-02-01 12:00:00", "ts")
    return checked.select(micros("latest"), rounded("age_days"), "status")


@query
def table_counts(spark, sf):
    return quality.table_counts({name: staged(spark, sf, name) for name in ("documents", "flights", "legs", "delays")})


@query
def grain_check(spark, sf):
    return quality.duplicate_keys(leg_versions(spark, sf), ["l_orderkey", "l_linenumber"])


@query
def orphans(spark, sf):
    lost = quality.orphans(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id", "doc_id")
    return lost.select("doc_id", "lang", "source")


@query
def missing_pct(spark, sf):
    columns = [
        "scheduled_flight_duration",
        "aircraft_type_code",
        "actual_departure",
        "actual_arrival",
        "departure_airport_code",
    ]
    return quality.missing_percentage(staged(spark, sf, "legs"), columns).withColumn("percentage", rounded("percentage"))


@query
def profile(spark, sf):
    return quality.profile(staged(spark, sf, "legs"))


@query
def cardinality(spark, sf):
    return quality.cardinality(
        staged(spark, sf, "legs"), ["aircraft_type_code", "departure_airport_code", "arrival_airport_code"]
    )


@query
def value_counts(spark, sf):
    return quality.value_counts(staged(spark, sf, "legs"), "departure_airport_code")


@query
def describe_delay(spark, sf):
    flat = flat_legs(spark, sf).select(delay_minutes().alias("minutes"))
    out = quality.describe_positive(flat, "minutes")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query
def join_guard(spark, sf):
    docs = _docs(spark, sf)
    before = entities.flight_legs(docs)
    return quality.join_growth(before, entities.legs_with_irregularity(before, entities.irregularities(docs)))


# ---- congestion and layered models ----


@query
def congestion_departures(spark, sf):
    return congestion.departures(flat_legs(spark, sf)).withColumn("movement_date", text("movement_date"))


@query
def congestion_arrivals(spark, sf):
    return congestion.arrivals(flat_legs(spark, sf)).withColumn("movement_date", text("movement_date"))


@query
def congestion_inner(spark, sf):
    return congestion.airport_congestion(flat_legs(spark, sf), "inner").withColumn("movement_date", text("movement_date"))


def _delays_leg(spark: SparkSession, sf: str, how: str = "sum") -> DataFrame:
    return intermediate.int_delays_leg(*raw_tables(spark, sf), how)


def _congestion(spark: SparkSession, sf: str) -> DataFrame:
    flights_, legs_, _ = raw_tables(spark, sf)
    dated = legs_.withColumnRenamed("id", "leg_id").join(
        flights_.select(F.col("id").alias("flight_id"), "flight_schedule_date"), "flight_id"
    )
    return intermediate.int_airport_congestion(dated)


def _counted(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Congestion as a stored table: its size is known before the legs are joined, so these need not move."""
    return landed_mart(spark, sf, name, build)


def _legs_ready(spark: SparkSession, sf: str) -> DataFrame:
    counted = _counted(spark, sf, "congestion_of_tables", lambda: _congestion(spark, sf))
    return intermediate.int_legs_ready(_delays_leg(spark, sf), counted)


def _nested_fact(spark: SparkSession, sf: str) -> DataFrame:
    docs = _docs(spark, sf)
    movements = intermediate.document_movements(docs)
    counted = _counted(spark, sf, "congestion_of_documents", lambda: intermediate.int_airport_congestion(movements))
    return mart.fct_flight_legs(intermediate.int_legs_ready(intermediate.int_delays_nested(docs), counted))


def mart_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The fact as a mart table, which rankings and models read."""
    return landed_mart(spark, sf, "fct_flight_legs", lambda: _nested_fact(spark, sf))


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text, timestamps as microseconds and delays rounded, so that engines agree."""
    changes = {}
    for name, kind in df.dtypes:
        if kind == "date":
            changes[name] = F.col(name).cast("string")
        elif kind == "timestamp":
            changes[name] = F.unix_micros(name)
        elif kind == "double":
            changes[name] = F.round(name, 6)
    return df.withColumns(changes)


@query
def congestion_full(spark, sf):
    return _plain(_congestion(spark, sf))


@query
def int_delays_leg(spark, sf):
    return _plain(_delays_leg(spark, sf))


@query
def int_delays_leg_max(spark, sf):
    return _plain(_delays_leg(spark, sf, "max").select("leg_id", "delay_code", "delay_duration_minutes"))


@query
def delays_per_leg_first(spark, sf):
    positioned = raw.raw_delays(normalize.delays(_docs(spark, sf), positioned=True))
    return intermediate.delays_per_leg(positioned, "first")


@query
def int_delays_exploded(spark, sf):
    return _plain(intermediate.int_delays_exploded(raw.raw_documents(_docs(spark, sf))))


@query
def int_legs_ready(spark, sf):
    return _plain(_legs_ready(spark, sf))


@query
def fct_flight_legs(spark, sf):
    """From the three normalised tables."""
    return _plain(mart.fct_flight_legs(_legs_ready(spark, sf)))


@query
def fct_from_documents(spark, sf):
    """The same fact from whole documents, without joining legs to flights and delays."""
    return _plain(_nested_fact(spark, sf))


@query
def int_delays_nested(spark, sf):
    return _plain(intermediate.int_delays_nested(_docs(spark, sf)))


@query
def int_delays_nested_max(spark, sf):
    rows = intermediate.int_delays_nested(_docs(spark, sf), "max")
    return _plain(rows.select("leg_id", "delay_code", "delay_duration_minutes"))


@query
def dim_airlines(spark, sf):
    return mart.dim_airlines(_delays_leg(spark, sf))


@query
def dim_airports(spark, sf):
    return mart.dim_airports(_delays_leg(spark, sf))


@query
def dim_date(spark, sf):
    return _plain(mart.dim_date(_delays_leg(spark, sf)))


@query
def dim_surrogate(spark, sf):
    return mart.with_surrogate_key(mart.dim_airports(_delays_leg(spark, sf)), "airport_key")


@query
def star_join(spark, sf):
    base = intermediate.int_delays_nested(_docs(spark, sf))
    joined = mart.star_join(mart_fact(spark, sf), mart.dim_airlines(base), mart.dim_airports(base), mart.dim_date(base))
    return _plain(
        joined.select(
            "leg_id",
            "airline_name",
            "departure_airport_code",
            "arrival_airport_code",
            "day_name",
            "day_of_week",
            "month",
            "year",
            "is_delayed",
        )
    )


# ---- entity model ----


@query
def codeshare(spark, sf):
    return entities.code_share_relations(_docs(spark, sf))


@query
def codeshare_flights(spark, sf):
    return entities.code_share_flights(_docs(spark, sf))


@query
def flight_relation(spark, sf):
    return entities.flight_relations(_docs(spark, sf))


@query
def relation_join(spark, sf):
    docs = _docs(spark, sf)
    return entities.related_flights(entities.flight_relations(docs), entities.scheduled_flights(docs))


@query
def entity_scheduled_flight(spark, sf):
    return entities.scheduled_flights(_docs(spark, sf)).withColumn("route", F.array_join("route", ">"))


@query
def entity_flight(spark, sf):
    return entities.operating_flights(_docs(spark, sf))


@query
def entity_airline(spark, sf):
    return entities.airlines(_docs(spark, sf))


@query
def entity_flight_leg(spark, sf):
    return entities.flight_legs(_docs(spark, sf))


def _entity(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[f"entity_{name}"] = lambda spark, sf: build(_docs(spark, sf))


_entity("airport", entities.airports)
_entity("city", entities.cities)
_entity("country", entities.countries)
_entity("aircraft", entities.aircraft)
_entity("irregularity", entities.irregularities)
_entity("delay", entities.delay_codes)
_entity("delay_reason", entities.delay_reasons)
_entity("cancel_reason", entities.cancel_reasons)


@query
def legs_irregularity(spark, sf):
    docs = _docs(spark, sf)
    joined = entities.legs_with_irregularity(entities.flight_legs(docs), entities.irregularities(docs))
    return joined.select("flightLegId", "scheduledFlightId", "scheduledFlightDuration", "delayDuration")


@query
def airport_geography(spark, sf):
    docs = _docs(spark, sf)
    return entities.airport_geography(entities.airports(docs), entities.cities(docs), entities.countries(docs))


@query
def leg_aircraft_owner(spark, sf):
    docs = _docs(spark, sf)
    return entities.leg_aircraft_owner(entities.flight_legs(docs), entities.aircraft(docs), entities.airlines(docs))


# ---- rankings and search ----


@query
def airline_rank(spark, sf):
    return _plain(rankings.airline_ranking(mart_fact(spark, sf)))


@query
def airport_rank(spark, sf):
    return _plain(rankings.airport_ranking(mart_fact(spark, sf)))


@query
def chronic_flights(spark, sf):
    return _plain(rankings.chronic_flights(mart_fact(spark, sf)))


@query
def chronic_routes(spark, sf):
    by = ["departure_airport_key", "arrival_airport_key"]
    return _plain(rankings.chronic_flights(mart_fact(spark, sf), 20, 0.15, by))


@query
def delay_causes(spark, sf):
    return _plain(rankings.delay_causes(staged(spark, sf, "delays")))


@query
def flight_search(spark, sf):
    found = search.flight_search(
        _delays_leg(spark, sf), "2026-01-05", "2026-01-12", carrier="HO", destination="N07", movement="A"
    )
    return _plain(found.select("leg_id", "flight_id", "scheduled_arrival", "departure_airport_code"))


@query
def flight_search_departures(spark, sf):
    found = search.flight_search(
        _delays_leg(spark, sf),
        "2026-01-10 06:00:00",
        "2026-01-10 18:00:00",
        origin="N03",
        time_origin="P",
        schedule_dates=("2026-01-08", "2026-01-12"),
    )
    return _plain(found.select("leg_id", "flight_id", "actual_departure", "arrival_airport_code"))


@query
def flight_lookup(spark, sf):
    wanted = "20260102+MA+0001"
    return normalize.flights(search.flight_lookup(_docs(spark, sf), wanted, "id")).select("id", "airline_name", "haul")


# ---- scalar functions ----


@query
def duration_minutes(spark, sf):
    legs_ = staged(spark, sf, "legs")
    length = F.col("scheduled_flight_duration")
    return legs_.select(
        "id",
        length.alias("duration"),
        durations.duration_minutes(length).alias("minutes"),
        durations.duration_minutes(length, "plain").alias("plain_minutes"),
        durations.duration_minutes(length, "two_digit").alias("two_digit_minutes"),
    )


@query
def signed_duration(spark, sf):
    legs_ = entities.prepared_legs(_docs(spark, sf), {"difference": "departureDateTimeDifference"})
    difference = F.col("difference")
    return legs_.select(
        "flightLegId",
        difference.alias("difference"),
        durations.signed_minutes(difference).alias("minutes"),
        durations.duration_minutes(difference, "plain").alias("unsigned_minutes"),
    )


@query
def id_parse(spark, sf):
    parts = keys.parse_flight_id(F.col("id")).alias("p")
    return _plain(_docs(spark, sf).select("id", parts).select("id", "p.*"))


@query
def local_calendar(spark, sf):
    legs_ = staged(spark, sf, "legs")
    departure, arrival = F.col("scheduled_departure"), F.col("scheduled_arrival")
    day = calendar.local_date(departure)
    return legs_.select(
        "id",
        day.cast("string").alias("departure_date"),
        calendar.local_date(arrival).cast("string").alias("arrival_date"),
        calendar.weekday(day).alias("weekday"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("monthday"),
        calendar.local_hour(departure).alias("hour"),
        calendar.local_hour(departure, compat=True).alias("compat_hour"),
        F.to_date(calendar.instant(departure)).cast("string").alias("utc_date"),
    )


@query
def list_rules(spark, sf):
    paths = {name: f"irregularity.{name}" for name in ("delayCode", "delayDuration", "cancelled")}
    first_duration = values.first_or(F.col("delayDuration"), "00")
    pairs = values.zip_short(F.col("delayCode"), F.col("delayDuration"))
    return entities.prepared_legs(_docs(spark, sf), paths).select(
        "flightLegId",
        values.first_or(F.col("delayCode"), "").alias("first_code"),
        first_duration.alias("first_duration"),
        values.int_or_zero(first_duration).alias("first_minutes"),
        F.coalesce(F.size(pairs), F.lit(0)).alias("nb_pairs"),
        values.is_yes(F.col("cancelled")).alias("cancelled"),
    )
