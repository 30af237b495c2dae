"""Queries for features, metrics, training and incremental loads."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.operators import features, metrics, neighbours, oversample, quality
from legwork.plans import learn
from legwork.session import work_dir
from legwork.sources.documents import rejected_pages, scan_pages
from legwork.sources.windows import missing_pages as pages_to_fetch
from legwork.sources.listings import scan_airports, scan_schedules
from legwork.sources.tables import append, read_table, replace
from legwork.streaming.ingest import current_tables, start_ingest, stream_documents
from suite.fixture import flat_legs, table
from suite.registry import _docs, _plain, mart_fact, query
from suite.staging import staged

_models: dict[tuple[str, str, str], tuple] = {}


# ---- features ----


@query
def dummies(spark, sf):
    return features.dummies(mart_fact(spark, sf).select("leg_id", "aircraft_type_code"), "aircraft_type_code")


@query
def one_hot(spark, sf):
    return features.one_hot(mart_fact(spark, sf).select("leg_id", "aircraft_type_code"), "aircraft_type_code")


SCALED = ["scheduled_flight_duration_min", "departure_month", "dep_airport_nb_departing"]


@query
def minmax(spark, sf):
    rows = mart_fact(spark, sf).select("leg_id", *SCALED)
    return _plain(features.fit_min_max(rows, SCALED).apply(rows))


@query
def standard(spark, sf):
    rows = mart_fact(spark, sf).select("leg_id", *SCALED)
    return _plain(features.fit_standard(rows, SCALED).apply(rows))


@query
def numeric_features(spark, sf):
    """Prepared features; a column that the input lacks is filled with 0."""
    rows = mart_fact(spark, sf).drop("departure_month")
    return features.prepare_numeric(rows).select("leg_id", *features.NUMERIC_FEATURES)


@query
def anova_topk(spark, sf):
    rows = features.prepare_numeric(mart_fact(spark, sf))
    best = features.best_features(rows, features.NUMERIC_FEATURES, "is_delayed", 5)
    return best.select("feature", F.round("f_value", 4).alias("f_value"))


@query
def best_dummies(spark, sf):
    """The whole chain: numbers and dummies, scaled to [0, 1], ranked by F, the best 20."""
    rows = features.prepare_numeric(mart_fact(spark, sf)).select(
        "is_delayed", *features.NUMERIC_FEATURES, *features.CATEGORICAL_FEATURES
    )
    for column in features.CATEGORICAL_FEATURES:
        rows = features.dummies(rows, column)
    names = [c for c in rows.columns if c != "is_delayed"]
    scaled = features.fit_min_max(rows, names).apply(rows)
    best = features.best_features(scaled, names, "is_delayed", 20)
    return best.where("f_value is not null").select("feature", F.round("f_value", 4).alias("f_value"))


@query
def class_weight(spark, sf):
    return _plain(features.class_weights(mart_fact(spark, sf), "is_delayed"))


@query
def stratified_split(spark, sf):
    split = features.stratified_split(mart_fact(spark, sf), "is_delayed", "leg_id", Fraction(1, 5), 42)
    return split.groupBy("is_delayed").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_train")).alias("nb_test")
    )


# ---- metrics on a fixed score ----


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    late = F.coalesce(F.col("departure_delay_minutes"), F.lit(0.0))
    return mart_fact(spark, sf).select(
        F.col("is_delayed").cast("int").alias("label"),
        (late * 1000 + F.col("scheduled_flight_duration_min")).alias("score"),
        (late >= 15).cast("int").alias("prediction"),
    )


@query
def confusion_metrics(spark, sf):
    return _plain(metrics.classification_metrics(_scored(spark, sf)))


@query
def roc_auc(spark, sf):
    return _plain(metrics.roc_auc(_scored(spark, sf)))


# ---- oversampling ----


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The model's own vectors, scaled, of all rows."""
    rows = learn.training_rows(mart_fact(spark, sf))
    made = learn.feature_pipeline().fit(rows).transform(rows)
    return learn.scaled_vectors(made, learn.vector_scale(made)).select("leg_id", "vec", "label")


@query
def smote_neighbours(spark, sf):
    """Distance from each delayed vector to its five nearest others, summed."""
    late = _vectors(spark, sf).where("label = 1")
    found = neighbours.nearest_in_blocks(neighbours.distinct_vectors(late, "leg_id", "vec"), 5)
    return found.groupBy("rep").agg(
        F.count(F.lit(1)).alias("nb_neighbours"), F.round(F.sum("distance"), 5).alias("total_distance")
    )


def balance_report(balanced: DataFrame) -> DataFrame:
    """Rows per class, and whether each synthetic value lies within its class's range of the dimension."""
    values = balanced.select("label", "is_synthetic", F.posexplode("vec").alias("place", "x"))
    real = values.where("not is_synthetic").groupBy("label", "place").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    outside = (
        values.where("is_synthetic")
        .join(real, ["label", "place"])
        .groupBy("label")
        .agg(F.count_if((F.col("x") < F.col("low") - 1e-9) | (F.col("x") > F.col("high") + 1e-9)).alias("nb_outside"))
    )
    counts = balanced.groupBy("label").agg(F.count(F.lit(1)).alias("nb_rows"), F.count_if("is_synthetic").alias("nb_synthetic"))
    return counts.join(outside, "label", "left").withColumn("nb_outside", F.coalesce("nb_outside", F.lit(0)))


@query
def smote_balanced(spark, sf):
    return balance_report(oversample.balance_classes(_vectors(spark, sf), "leg_id", "vec", "label"))


# ---- training: each model is fitted once per session ----


def _trained(spark: SparkSession, sf: str, kind: str) -> tuple[learn.DelayModel, DataFrame]:
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _models:
        _models[key] = learn.train(learn.training_rows(mart_fact(spark, sf)), learn.Settings(), kind)
    return _models[key]


def _checked(scored: DataFrame) -> DataFrame:
    """Scored legs with what must hold of any model's scores."""
    p = F.col("delay_probability")
    agrees = F.col("delay_predicted") == (p > 0.5).cast("int")
    return scored.select(
        "leg_id", "flight_id", p.between(0, 1).alias("in_range"), (agrees | (F.abs(p - 0.5) < 1e-9)).alias("agrees")
    )


@query
def forest_scored(spark, sf):
    model, rows = _trained(spark, sf, "forest")
    return _checked(learn.scored_table(learn.score(model, rows)))


@query
def forest_metrics(spark, sf):
    """The test share by class as the metrics see it, and whether the scores rank well."""
    model, rows = _trained(spark, sf, "forest")
    found = learn.evaluate(learn.score(model, rows))
    positives = F.col("tp") + F.col("fn")
    negatives = F.col("tn") + F.col("fp")
    return found.select(positives.alias("nb_late"), negatives.alias("nb_in_time"), (F.col("auc") > 0.4).alias("ranks"))


@query
def feature_importance(spark, sf):
    """Every feature once, and their sum."""
    found = learn.feature_importance(_trained(spark, sf, "forest")[0])
    total = found.agg(F.round(F.sum("importance"), 6).alias("total"))
    return found.select("feature").crossJoin(F.broadcast(total))  # one row


@query
def model_reloaded(spark, sf):
    """Scores of a model that was saved and loaded again."""
    model, rows = _trained(spark, sf, "forest")
    folder = work_dir(spark)
    model.save(folder)
    return _checked(learn.scored_table(learn.score(learn.load_model(folder), rows)))


@query
def gbt_scored(spark, sf):
    model, rows = _trained(spark, sf, "boosted")
    return _checked(learn.scored_table(learn.score(model, rows)))


# ---- landed pages ----

#: Pages repeat their keys in every leg, so they are landed compressed. Compressed files are read whole, so each holds a bounded number.
LANDED = {"compression": "gzip", "maxRecordsPerFile": 50_000}


def _pages(docs: DataFrame, stamp: str) -> DataFrame:
    content = [c for c in docs.columns if c != "fetched_at"]
    return docs.select(
        F.struct(F.lit(1).alias("totalPages")).alias("page"),
        F.lit(stamp).alias("fetchedAt"),
        F.array(F.struct(*content)).alias("operationalFlights"),
    )


@query
def json_scan(spark, sf):
    """All documents written as pages and read back."""
    landing = work_dir(spark)
    _pages(_docs(spark, sf), "2026-02-01 00:00:00").write.options(**LANDED).json(f"{landing}/pages")
    docs = scan_pages(spark, f"{landing}/pages", one_page_per_line=True)
    return docs.select(
        "id",
        F.col("airline.name").alias("airline_name"),
        F.array_join("route", ">").alias("route"),
        F.size("flightLegs").alias("nb_legs"),
        F.col("fetched_at").cast("string").alias("fetched_at"),
    )


@query
def landing_replay(spark, sf):
    """Pages that are to be fetched again: those rejected at the scan; quoted numbers are no reason."""
    docs = _docs(spark, sf)
    landing = f"{work_dir(spark)}/landing"
    quoted = docs.withColumn("flightNumber", F.concat(F.lit("0"), F.col("flightNumber").cast("string")))
    lines = _pages(quoted, "2026-02-01 00:00:00").select(
        F.col("operationalFlights")[0]["flightNumber"].cast("int").alias("number"), F.to_json(F.struct("*")).alias("value")
    )
    broken = F.col("number") % 10 == 0
    lines.select(F.when(broken, F.concat(F.lit("{ cut "), "value")).otherwise(F.col("value"))).write.options(**LANDED).text(landing)
    good = scan_pages(spark, landing, one_page_per_line=True).select("id")
    lost = rejected_pages(spark, landing, one_page_per_line=True)
    plan = docs.select("id", F.col("flightNumber").alias("flight_number"))
    again = pages_to_fetch(plan, good, ["id"])
    return again.crossJoin(F.broadcast(lost.agg(F.count("*").alias("nb_rejected"))))  # one row


@query
def airport_scan(spark, sf):
    """Airport listings written as pages and read back."""
    code = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    row = F.struct(
        code.alias("iata_code"),
        F.initcap("n_name").alias("name"),
        (F.col("n_nationkey") * 3.5).alias("lat"),
        F.col("n_regionkey").alias("lng"),
        F.substring("n_name", 1, 2).alias("country_code"),
        F.lit(2).alias("runways"),
    )
    landing = f"{work_dir(spark)}/airports"
    table(spark, sf, "nation").select(F.array(row).alias("response")).write.json(landing)
    found = scan_airports(spark, landing, "2026-02-01 00:00:00", one_page_per_line=True)
    return found.withColumn("ingested_at", F.col("ingested_at").cast("string"))


@query
def stream_merge(spark, sf):
    """Three landings in turn: all flights, newer pages of some, and older pages that come late."""
    docs = _docs(spark, sf)
    folder = work_dir(spark)
    no_irregularity = F.transform(
        "flightLegs", lambda leg: leg.withField("irregularity", F.lit(None).cast("string"))
    )

    def changed(wanted: Column, status: str) -> DataFrame:
        return docs.where(wanted).withColumns({"flightStatusPublic": F.lit(status), "flightLegs": no_irregularity})

    landings = [
        (docs, "2026-02-01 00:00:00"),
        (changed(F.col("flightNumber") % 2 == 0, "UPDATED"), "2026-02-02 00:00:00"),
        (changed(F.col("flightNumber") % 3 == 0, "STALE"), "2026-01-31 00:00:00"),
    ]
    for rows, stamp in landings:
        _pages(rows, stamp).write.mode("append").options(**LANDED).json(f"{folder}/landing")
        stream = stream_documents(spark, f"{folder}/landing", one_page_per_line=True)
        start_ingest(stream, f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()
    tables = current_tables(spark, f"{folder}/tables")
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
def schedule_scan(spark, sf):
    """Schedule listings written as pages and read back with their times parsed."""
    minute = F.concat(F.substring("scheduled_departure", 1, 10), F.lit(" "), F.substring("scheduled_departure", 12, 5))
    row = F.struct(
        F.concat("airline_code", F.col("flight_number").cast("string")).alias("flight_iata"),
        F.col("departure_airport_code").alias("dep_iata"),
        F.col("published_status").alias("status"),
        minute.alias("dep_time"),
        F.col("quantity").alias("dep_delayed"),
    )
    landing = work_dir(spark)
    flat_legs(spark, sf).select(F.array(row).alias("response")).write.options(**LANDED).json(f"{landing}/schedules")
    found = scan_schedules(spark, f"{landing}/schedules", "2026-02-01 00:00:00", one_page_per_line=True)
    return found.select(
        "flight_iata",
        "dep_iata",
        "arr_iata",
        "status",
        F.unix_micros("dep_time").alias("dep_time"),
        F.col("ingested_at").cast("string").alias("ingested_at"),
    )


@query
def append_and_replace(spark, sf):
    """Rows after appending the delays twice, and after replacing them."""
    delays = staged(spark, sf, "delays")
    folder = work_dir(spark)
    append(delays, f"{folder}/appended")
    append(delays, f"{folder}/appended")
    replace(delays, f"{folder}/replaced")
    replace(delays, f"{folder}/replaced")
    return quality.table_counts(
        {name: read_table(spark, f"{folder}/{name}", ["id"]) for name in ("appended", "replaced")}
    )
