"""Queries over stored and incrementally kept tables: pruned searches, stateful loads, sketches, counts of a running job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.operators import entities, features, hashed_neighbours, neighbours, oversample, quality, sketches
from legwork.operators.observed import guarded_join, write_counted
from legwork.plans import mart, stored
from legwork.session import work_dir
from legwork.sources import ledger
from legwork.sources.documents import documents_from_payload
from legwork.sources.tables import read_table, replace
from legwork.streaming import current
from legwork.streaming.ingest import stream_documents
from suite.fixture import delay_minutes, flat_legs
from suite.learning import LANDED, _pages, _vectors, balance_report
from suite.registry import _docs, _plain, mart_fact, query
from suite.staging import landed_at, staged

# ---- pruned searches ----


def _stored_fact(spark: SparkSession, sf: str) -> str:
    return landed_at(spark, sf, "stored_fact", lambda path: stored.write_fact(mart_fact(spark, sf), path))


@query
def search_stored(spark, sf):
    """Arrivals of a week, from the days that can hold them."""
    found = stored.search(
        spark, _stored_fact(spark, sf), "2026-01-05", "2026-01-12", movement="A", carrier="HO", destination="N07"
    )
    return _plain(found.select("leg_id", "flight_id", "scheduled_arrival", "departure_airport_code"))


@query
def search_stored_departures(spark, sf):
    """Actual departures of twelve hours, without any date given."""
    found = stored.search(
        spark, _stored_fact(spark, sf), "2026-01-10 06:00:00", "2026-01-10 18:00:00", time_origin="P", origin="N03"
    )
    return _plain(found.select("leg_id", "flight_id", "actual_departure", "arrival_airport_code"))


@query
def lookup_stored(spark, sf):
    found = stored.lookup(spark, _stored_fact(spark, sf), "20260102+MA+0001")
    return _plain(found.select("leg_id", "flight_id", "date_key", "scheduled_departure", "departure_airport_key"))


def _stored_dims(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dimensions from the table that holds their columns alone."""
    flights = staged(spark, sf, "flights").withColumn("flight_schedule_date", F.col("flight_schedule_date").cast("date"))
    builds = {
        "dim_airlines": lambda: mart.dim_airlines(flights),
        "dim_airports": lambda: mart.dim_airports(staged(spark, sf, "legs")),
        "dim_date": lambda: mart.dim_date(flights),
    }
    airlines, airports, dates = (
        read_table(spark, landed_at(spark, sf, name, lambda path, build=build: replace(build(), path)))
        for name, build in builds.items()
    )
    return airlines, airports, dates


@query
def star_fridays(spark, sf):
    """The star join on Fridays; the day's name prunes the fact's partitions."""
    fact = stored.read_fact(spark, _stored_fact(spark, sf))
    joined = stored.star_on_days(fact, *_stored_dims(spark, sf), F.col("day_name") == "Friday")
    return _plain(joined.select("leg_id", "airline_name", "departure_airport_code", "arrival_airport_code", "date_key", "is_delayed"))


# ---- stateful loads ----


def _landings(docs: DataFrame) -> list[tuple[DataFrame, str]]:
    """All flights, newer pages of some with at most two legs, and older pages without legs that come late."""

    def changed(wanted: Column, status: str, legs: Column) -> DataFrame:
        return docs.where(wanted).withColumns({"flightStatusPublic": F.lit(status), "flightLegs": legs})

    no_irregularity = F.transform("flightLegs", lambda leg: leg.withField("irregularity", F.lit(None).cast("string")))
    none = F.lit(None).cast(docs.schema["flightLegs"].dataType)
    return [
        (docs, "2026-02-01 00:00:00"),
        (changed(F.col("flightNumber") % 2 == 0, "UPDATED", F.slice(no_irregularity, 1, 2)), "2026-02-02 00:00:00"),
        (changed(F.col("flightNumber") % 3 == 0, "STALE", none), "2026-01-31 00:00:00"),
    ]


def _loaded(spark: SparkSession, sf: str) -> str:
    def load(folder: str) -> None:
        for rows, stamp in _landings(_docs(spark, sf)):
            _pages(rows, stamp).write.mode("append").options(**LANDED).json(f"{folder}/landing")
            stream = stream_documents(spark, f"{folder}/landing", one_page_per_line=True)
            current.start_current(stream, f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()

    return landed_at(spark, sf, "stateful", load)


@query
def stream_current(spark, sf):
    """Flights after the landings, with their legs and delays."""
    tables = current.current_tables(spark, f"{_loaded(spark, sf)}/tables")
    counted = [
        tables[name].groupBy("flight_id").agg(F.count(F.lit(1)).alias(f"nb_{name}")).withColumnRenamed("flight_id", "id")
        for name in ("legs", "delays")
    ]
    joined = tables["flights"].join(counted[0], "id", "left").join(counted[1], "id", "left")
    return joined.select(
        "id",
        "flight_status_public",
        F.col("fetched_at").cast("string").alias("fetched_at"),
        F.coalesce("nb_legs", F.lit(0)).alias("nb_legs"),
        F.coalesce("nb_delays", F.lit(0)).alias("nb_delays"),
    )


@query
def stream_congestion(spark, sf):
    """Congestion after the landings, from what each of them changed."""
    return _plain(current.current_congestion(spark, f"{_loaded(spark, sf)}/tables"))


# ---- near neighbours by hashing ----


@query
def smote_hashed(spark, sf):
    """``smote_balanced`` with neighbours found by random projections."""
    return balance_report(oversample.balance_classes(_vectors(spark, sf), "leg_id", "vec", "label", how="hashed"))


@query
def neighbour_recall(spark, sf):
    """Delayed vectors, and whether the hashed search finds nine of ten of their exact neighbours."""
    late = neighbours.distinct_vectors(_vectors(spark, sf).where("label = 1"), "leg_id", "vec")
    met = hashed_neighbours.recall(hashed_neighbours.nearest_by_hash(late, 5), neighbours.nearest_in_blocks(late, 5))
    return met.select("nb_wanted", (F.col("recall") >= 0.9).alias("reached"))


# ---- quantiles and distinct counts ----


@query
def describe_delay_exact(spark, sf):
    """``describe_delay`` by a sketch and counts."""
    out = sketches.describe_exact(flat_legs(spark, sf).select(delay_minutes().alias("minutes")), "minutes")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


def _daily(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    return read_table(spark, landed_at(spark, sf, name, lambda path: replace(build(), path)))


@query
def quantiles_by_week(spark, sf):
    """Quartiles of flight lengths per week from stored daily sketches, and whether their ranks are within the error."""
    rows = mart_fact(spark, sf).select("date_key", F.col("scheduled_flight_duration_min").alias("minutes"))
    daily = _daily(spark, sf, "daily_quantiles", lambda: sketches.daily_quantile_sketches(rows, "date_key", "minutes"))
    week = F.floor(F.datediff("date_key", F.lit("2026-01-01").cast("date")) / 7).cast("int")
    asked = [0.25, 0.5, 0.75]
    found = sketches.sketched_quantiles(daily.withColumn("week", week), asked, ["week"])
    beside = rows.withColumn("week", week).join(found, "week")
    below = beside.groupBy("week", "n").agg(
        *[x.alias(f"{which}{i}") for i in range(3) for which, x in (("u", F.count_if(F.col("minutes") < F.col(f"q{i}"))), ("v", F.count_if(F.col("minutes") <= F.col(f"q{i}"))))]
    )
    room = F.col("n") * sketches.RANK_ERROR + 1
    near = F.lit(True)
    for i, p in enumerate(asked):
        near &= (F.col(f"u{i}") <= F.col("n") * p + room) & (F.col(f"v{i}") >= F.col("n") * p - room)
    return below.select("week", "n", near.alias("within"))


@query
def distinct_by_day(spark, sf):
    """Different values of each code per day and over the month, from stored daily sketches."""
    columns = ["airline_key", "aircraft_type_code", "departure_airport_key", "arrival_airport_key"]
    daily = _daily(spark, sf, "daily_distinct", lambda: sketches.daily_distinct_sketches(mart_fact(spark, sf), "date_key", columns))
    days = sketches.distinct_over(daily, ["date_key"]).withColumn("span", F.col("date_key").cast("string")).drop("date_key")
    return days.unionByName(sketches.distinct_over(daily).withColumn("span", F.lit("all")))


@query
def distinct_flights(spark, sf):
    """Whether the month's number of different flights is within the error of the exact one."""
    daily = _daily(spark, sf, "daily_flights", lambda: sketches.daily_distinct_sketches(mart_fact(spark, sf), "date_key", ["flight_id"]))
    exact = mart_fact(spark, sf).agg(F.count_distinct("flight_id").alias("n_flights"))
    found = sketches.distinct_over(daily).select("n_values")
    gap = F.abs(F.col("n_values") - F.col("n_flights"))
    return exact.join(F.broadcast(found), F.lit(True)).select(  # one row each
        "n_flights", (gap <= F.col("n_flights") * sketches.DISTINCT_ERROR + 1).alias("within")
    )


# ---- counts of a running job ----


@query
def join_guard_observed(spark, sf):
    """``join_guard`` with both counts taken while the join is written."""
    docs = _docs(spark, sf)
    reasons = entities.irregularities(docs)
    _, found = guarded_join(
        entities.flight_legs(docs), lambda legs: entities.legs_with_irregularity(legs, reasons), f"{work_dir(spark)}/guarded"
    )
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{name} bigint" for name in found))


@query
def counts_observed(spark, sf):
    """Rows of each table, counted while it is written."""
    folder = work_dir(spark)
    counts = [(name, write_counted(staged(spark, sf, name), f"{folder}/{name}")) for name in ("documents", "flights", "legs", "delays")]
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


# ---- checks over whole tables ----


@query
def missing_pct_all(spark, sf):
    """Every column of the fact, also those without nulls."""
    return quality.missing_percentage(mart_fact(spark, sf), over=-1.0).withColumn("percentage", F.round("percentage", 6))


@query
def cardinality_all(spark, sf):
    """Every text column of the legs and of their flights."""
    legs = staged(spark, sf, "legs")
    flights = staged(spark, sf, "flights").select(F.col("id").alias("flight_id"), "airline_code", "airline_name", "haul", "flight_status_public")
    rows = legs.join(flights, "flight_id")
    return quality.cardinality(rows, [name for name, kind in rows.dtypes if kind == "string"])


# ---- features without a column per level ----


@query
def best_dummies_sparse(spark, sf):
    """``best_dummies`` from sparse vectors."""
    rows = features.prepare_numeric(mart_fact(spark, sf))
    best = features.best_sparse_features(rows, features.NUMERIC_FEATURES, features.CATEGORICAL_FEATURES, "is_delayed", 20)
    return best.withColumn("f_value", F.round("f_value", 4))


# ---- loads that remember their windows ----


def _remembered(spark: SparkSession, sf: str) -> str:
    """Two runs over pages of some fifty flights by schedule day; the first cannot have a third of its pages."""

    def load(folder: str) -> None:
        docs = _docs(spark, sf).withColumn("day", F.col("flightScheduleDate"))
        sizes = docs.groupBy("day").agg(F.ceil(F.count(F.lit(1)) / 50).cast("int").alias("total_pages"))
        content = [c for c in docs.columns if c not in ("fetched_at", "day")]
        page = F.pmod(F.xxhash64("id"), F.col("total_pages")).cast("int").alias("page_number")
        placed = docs.join(sizes, "day").select("day", page, F.struct(*content).alias("doc"))
        body = F.to_json(F.struct(F.lit("2026-02-01 00:00:00").alias("fetchedAt"), F.collect_list("doc").alias("operationalFlights")))
        ledger.write_pages(placed.groupBy("day", "page_number").agg(body.alias("body")), f"{folder}/pages")
        sizes.write.parquet(f"{folder}/sizes")
        pages, sizes = spark.read.parquet(f"{folder}/pages"), spark.read.parquet(f"{folder}/sizes")
        day = F.date_format("window_start", "yyyy-MM-dd").alias("day")

        def count(windows: DataFrame) -> DataFrame:
            return windows.select("*", day).join(sizes, "day", "left").fillna(0, ["total_pages"])

        def fetch(plan: DataFrame, whole: bool) -> DataFrame:
            found = plan.select("*", day).join(pages, ["day", "page_number"])
            return found if whole else found.where("page_number % 3 <> 1")

        for now, whole in (("2026-01-17 00:00:00", False), ("2026-02-01 00:00:00", True)):
            ledger.run_load(spark, f"{folder}/load", count, lambda plan, whole=whole: fetch(plan, whole), now, "2025-12-31")

    return f"{landed_at(spark, sf, 'remembered', load)}/load"


@query
def ledger_load(spark, sf):
    """Flights after both runs: every one once."""
    docs = documents_from_payload(ledger.read_loaded(spark, _remembered(spark, sf)))
    return docs.select("id", F.col("airline.name").alias("airline_name"), F.size("flightLegs").alias("nb_legs"))


@query
def ledger_pages(spark, sf):
    """Pages per window, by status and run."""
    pages = ledger.read_ledger(spark, _remembered(spark, sf))
    day = F.date_format("window_start", "yyyy-MM-dd").alias("day")
    return pages.groupBy(day, "status", "run").agg(F.count(F.lit(1)).alias("n"))
