"""Behaviour that matters on large, skewed tables."""

from pyspark.sql import functions as F

from legwork.operators.congestion import airport_congestion, attach_congestion
from legwork.operators.normalize import legs
from legwork.session import build_session, work_dir
from legwork.sources.documents import scan_pages
from tests.samples import ALPHA, NO_LEGS, write_page


def final_plan(df):
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    return plan.toString()


def test_hub_airport_day_is_split_when_counts_are_too_large_to_broadcast(spark):
    hub = F.col("id") % 3 == 0
    rows = spark.range(0, 300_000, 1, 16).select(
        F.concat(F.lit("leg"), "id").alias("leg_id"),
        F.when(hub, "HUB").otherwise(F.concat(F.lit("A"), F.col("id") % 4000)).alias("departure_airport_code"),
        F.concat(F.lit("A"), F.col("id") % 4001).alias("arrival_airport_code"),
        F.lit("2026-01-01").cast("date").alias("flight_schedule_date"),
        F.lit("2026-01-01").cast("date").alias("arrival_date"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        joined = attach_congestion(rows, airport_congestion(rows, unique=True))
        assert "skewed" in final_plan(joined)
        hubs = joined.where("departure_airport_code = 'HUB'").agg(
            F.count(F.lit(1)).alias("n"), F.min("dep_airport_nb_departing").alias("low"), F.max("dep_airport_nb_departing").alias("high")
        )
        assert tuple(hubs.first()) == (100_000, 100_000, 100_000)
        assert joined.count() == 300_000
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_congestion_combines_before_its_only_shuffle(spark):
    rows = spark.range(1000).select(
        F.lit("A").alias("departure_airport_code"),
        F.lit("B").alias("arrival_airport_code"),
        F.current_date().alias("flight_schedule_date"),
        F.current_date().alias("arrival_date"),
    )
    plan = final_plan(airport_congestion(rows, unique=True)).split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan


def test_leg_scan_reads_only_the_needed_leaves(spark, tmp_path):
    write_page(tmp_path / "p", "a.json", [ALPHA, NO_LEGS])
    scan_pages(spark, str(tmp_path / "p")).write.parquet(str(tmp_path / "docs"))
    plan = legs(spark.read.parquet(str(tmp_path / "docs")))._jdf.queryExecution().optimizedPlan()
    read = plan.collectLeaves().head().output().toString()
    schema = plan.collectLeaves().head().schema().simpleString()
    assert "flightLegs" in read
    assert "publishedStatus" in schema and "places" not in schema and "boardingTimes" not in schema


def test_shuffle_starts_wide_for_large_inputs(spark):
    again = build_session("tests", input_bytes=100 * 2**40)
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert again is spark and int(again.conf.get(name)) == 20_000
    again.conf.unset(name)


def test_work_folder_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = work_dir(spark)
    assert folder != work_dir(spark) and (shared is None or folder.startswith(shared))
