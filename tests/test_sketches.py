"""Quantiles and distinct counts against exact ones; counts of a running job; hashed neighbours."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from legwork.operators import hashed_neighbours, neighbours, observed, oversample, sketches


@pytest.mark.parametrize("seed, few", [(1, 10_000), (2, 40), (3, 8)])
def test_exact_quantiles(spark, seed, few):
    rng = random.Random(seed)
    values = [rng.choice([None, float(rng.randint(-3, 3)), rng.gauss(0, 50), 7.0, 7.0, 7.0]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    asked = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = sketches.exact_quantiles(df, "x", asked, few)
    want = np.quantile([v for v in values if v is not None], asked)
    assert [got[p] for p in asked] == pytest.approx(want.tolist())


def test_exact_quantiles_where_the_sketch_errs(spark, monkeypatch):
    """Brackets that miss the rank on either side are noticed by the counts."""
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    turns = iter([(900.0, 950.0), (0.0, 10.0), (990.0, 995.0)])
    real = sketches._brackets
    monkeypatch.setattr(sketches, "_brackets", lambda d, ranks, n: dict.fromkeys(ranks, b) if (b := next(turns, None)) else real(d, ranks, n))
    assert sketches.values_at(df, "x", [500], 20) == {500: 500.0}


def test_quantiles_of_few_values(spark):
    one = spark.createDataFrame([(4,)], "x int")
    assert sketches.exact_quantiles(one, "x", [0.5]) == {0.5: 4.0}
    assert sketches.exact_quantiles(one.limit(0), "x", [0.5]) == {0.5: None}
    row = sketches.describe_exact(one.limit(0), "x").first()
    assert (row.n, row.p50, row.max) == (0, None, None)


def test_no_task_or_driver_holds_all_values(spark, monkeypatch):
    df = spark.range(0, 200_000, 1, 4).select((F.col("id") * 7919 % 200_003).alias("x"))
    assert sketches.exact_quantiles(df, "x", [0.5], few=500)[0.5] == float(np.median([i * 7919 % 200_003 for i in range(200_000)]))
    plan = sketches.describe_exact(df, "x", 500)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan


def test_daily_sketches_merge(spark):
    rows = spark.range(0, 60_000, 1, 4).select((F.col("id") % 5).alias("day"), (F.col("id") * 31 % 10_007).alias("x"), F.when(F.col("id") % 3 > 0, F.col("id") % 40).alias("code"))
    daily = sketches.daily_quantile_sketches(rows, "day", "x")
    found = sketches.sketched_quantiles(daily, [0.5]).first()
    assert daily.count() == 5 and found.n == 60_000
    assert abs(rows.where(F.col("x") < found.q0).count() - 30_000) <= 60_000 * sketches.RANK_ERROR + 10
    counts = sketches.daily_distinct_sketches(rows, "day", ["x", "code"])
    month = {r.column_name: r.n_values for r in sketches.distinct_over(counts).collect()}
    assert month["code"] == 41 and abs(month["x"] - 10_007) <= 10_007 * sketches.DISTINCT_ERROR
    days = {r.day: r.n_values for r in sketches.distinct_over(counts, ["day"]).where("column_name = 'code'").collect()}
    exact = {r.day: r.n for r in rows.groupBy("day").agg((F.count_distinct("code") + 1).alias("n")).collect()}
    assert days == exact


def test_distinct_of_nulls_alone(spark):
    rows = spark.createDataFrame([(1, None), (1, None)], "day int, c string")
    assert sketches.distinct_over(sketches.daily_distinct_sketches(rows, "day", ["c"])).first().n_values == 1


def test_a_guarded_join_counts_in_one_job(spark, tmp_path):
    left = spark.range(0, 100, 1, 2).withColumn("k", F.col("id") % 10)
    right = spark.createDataFrame([(k, c) for k in range(5) for c in "ab"], "k long, c string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spark.sparkContext.setJobGroup("guard", "one job")
        rows, found = observed.guarded_join(left, lambda l: l.join(right, "k", "left"), str(tmp_path / "j"))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("guard")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert found == {"before_rows": 100, "after_rows": 150, "added_rows": 50} and rows.count() == 150
    assert len(jobs) == 1
    with pytest.raises(ValueError, match="added 50 rows"):
        observed.guarded_join(left, lambda l: l.join(right, "k", "left"), str(tmp_path / "k"), most_added=0)
    assert observed.write_counted(left, str(tmp_path / "w")) == 100


def clustered(spark, n=3000, dims=20, seed=3):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(40, dims))[rng.integers(0, 40, n)] * 5 + rng.normal(size=(n, dims))
    rows = [(f"p{i:05d}", x.tolist()) for i, x in enumerate(points)] + [("q1", points[0].tolist()), ("q2", points[0].tolist())]
    return neighbours.distinct_vectors(spark.createDataFrame(rows, "key string, vec array<double>"), "key", "vec")


def test_hashed_neighbours_reach_nine_of_ten(spark):
    vectors = clustered(spark)
    exact = neighbours.nearest_in_blocks(vectors, 5, 256)
    found = hashed_neighbours.nearest_by_hash(vectors, 5, block_rows=64)
    row = hashed_neighbours.recall(found, exact).first()
    assert row.nb_wanted == 15_000 and row.recall >= 0.9
    got = found.groupBy("rep").agg(F.count("*").alias("n"), F.max("place").alias("last")).where("n <> 5 or last <> 5")
    assert got.isEmpty() and found.where("rep = neighbour").isEmpty()


def test_hashed_neighbours_of_few_rows(spark):
    rows = [("a", [0.0, 0.0]), ("b", [0.0, 1.0]), ("c", [5.0, 5.0])]
    vectors = neighbours.distinct_vectors(spark.createDataFrame(rows, "key string, vec array<double>"), "key", "vec")
    found = {(r.rep, r.neighbour, r.place) for r in hashed_neighbours.nearest_by_hash(vectors, 5).collect()}
    assert found == {("a", "b", 1), ("a", "c", 2), ("b", "a", 1), ("b", "c", 2), ("c", "b", 1), ("c", "a", 2)}
    assert hashed_neighbours.nearest_by_hash(vectors.limit(1), 5).count() == 0
    assert hashed_neighbours.nearest_by_hash(vectors.limit(0), 5).count() == 0


def test_recall_sees_what_is_missing(spark):
    exact = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0)], "rep string, distance double")
    found = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "rep string, distance double")
    assert tuple(hashed_neighbours.recall(found, exact).first()) == (3, 1, pytest.approx(1 / 3))


def test_oversampling_with_hashed_neighbours(spark):
    rows = [(f"m{i}", [float(i), float(i % 7)], 1) for i in range(30)] + [(f"n{i}", [float(i), 0.0], 0) for i in range(100)]
    df = spark.createDataFrame(rows, "key string, vec array<double>, label int")
    made = oversample.balance_classes(df, "key", "vec", "label", how="hashed")
    assert {(r.label, r["count"]) for r in made.groupBy("label").count().collect()} == {(0, 100), (1, 100)}
    with pytest.raises(ValueError, match="unknown how"):
        oversample.balance_classes(df, "key", "vec", "label", how="near")
