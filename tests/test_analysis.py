import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from legwork.operators import congestion, features, metrics, neighbours, ordering, oversample, quality, rankings, search
from legwork.plans import learn, mart


@pytest.fixture(scope="module")
def legs(spark):
    rows = [
        ("l1", "AAA", "BBB", "2026-01-01", "2026-01-01"),
        ("l2", "AAA", "CCC", "2026-01-01", "2026-01-02"),
        ("l2", "AAA", "CCC", "2026-01-01", "2026-01-02"),
        ("l3", "BBB", "AAA", "2026-01-01", "2026-01-01"),
        ("l4", None, "AAA", "2026-01-01", None),
    ]
    schema = "leg_id string, departure_airport_code string, arrival_airport_code string, flight_schedule_date string, arrival_date string"
    return spark.createDataFrame(rows, schema).withColumns(
        {c: F.col(c).cast("date") for c in ("flight_schedule_date", "arrival_date")}
    )


def counts(df):
    return {(r[0], str(r[1])): tuple(r[2:]) for r in df.collect()}


def test_congestion_counts_each_leg_once(legs):
    full = counts(congestion.airport_congestion(legs))
    assert full[("AAA", "2026-01-01")] == (2, 1)
    assert full[("CCC", "2026-01-02")] == (0, 1)
    assert full[(None, "2026-01-01")] == (1, 0)
    assert sum(d for d, _ in full.values()) == 4 == sum(a for _, a in full.values())
    assert counts(congestion.departures(legs))[("AAA", "2026-01-01")] == (2,)
    assert counts(congestion.departures(legs, unique=True))[("AAA", "2026-01-01")] == (3,)


def test_inner_congestion_keeps_days_with_both_directions(legs):
    assert set(counts(congestion.airport_congestion(legs, "inner"))) == {("AAA", "2026-01-01"), ("BBB", "2026-01-01")}


def test_attached_congestion_keeps_every_leg(legs):
    joined = congestion.attach_congestion(legs, congestion.airport_congestion(legs))
    assert joined.count() == legs.count()
    assert joined.where("leg_id = 'l4'").first()["arr_airport_nb_departing"] is None


def test_airline_dimension_has_one_row_per_key(spark):
    rows = spark.createDataFrame([("ZA", "Old", 1), ("ZA", "New", 2), (None, "x", 3)], "airline_code string, airline_name string, flight_schedule_date int")
    assert [tuple(r) for r in mart.dim_airlines(rows).collect()] == [("ZA", "ZA", "New")]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "x", None), (2, None, "b"), (None, None, "b")], "k int, v string, w string")
    missing = [(r[0], r[1]) for r in quality.missing_percentage(df).collect()]
    assert missing == [("v", 75.0), ("k", 25.0), ("w", 25.0)]
    assert quality.missing_percentage(df, over=50.0).count() == 1
    assert {r["column_name"]: r["n_values"] for r in quality.cardinality(df, ["k", "v", "w"]).collect()} == {"k": 3, "v": 2, "w": 3}
    assert {r["column_name"]: r["n_values"] for r in quality.cardinality(df, ["k", "w"], True).collect()} == {"k": 3, "w": 3}
    assert [tuple(r) for r in quality.value_counts(df, "w").collect()] == [("b", 2), ("a", 1)]
    assert [tuple(r) for r in quality.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.orphans(df, df.where("k = 1"), "k", "k").select("k").collect()] == [(2,)]
    assert tuple(quality.join_growth(df, df.unionByName(df)).first()) == (4, 8, 4)
    assert {r["column_name"]: (r["non_null"], r["data_type"]) for r in quality.profile(df).collect()}["k"] == (3, "int")


def test_freshness_limits(spark):
    for stamp, status in (("2026-01-10 00:00:00", "pass"), ("2026-01-08 00:00:00", "warn"), ("2026-01-01", "error"), (None, "error")):
        df = spark.createDataFrame([(stamp,)], "fetched_at string")
        assert quality.freshness(df, "2026-01-10 12:00:00").first()["status"] == status


def test_describe_leaves_out_zero(spark):
    row = quality.describe_positive(spark.createDataFrame([(0,), (10,), (20,), (30,), (None,)], "m int"), "m").first()
    assert (row["n"], row["mean"], row["p50"], row["min"], row["max"]) == (3, 20.0, 20.0, 10.0, 30.0)


def test_rankings(spark):
    rows = [("ZA", 1, 20, True), ("ZA", 1, 0, False), ("ZB", 2, None, False), ("ZB", 2, None, False)]
    fact = spark.createDataFrame(rows, "airline_key string, flight_number int, delay_duration_minutes int, is_delayed boolean")
    ranked = {r["airline_key"]: r for r in rankings.airline_ranking(fact).collect()}
    assert ranked["ZB"]["punctuality_rank"] == 1 and ranked["ZA"]["mean_delay"] == 10.0
    assert [r["flight_number"] for r in rankings.chronic_flights(fact, 2, 0.5).collect()] == [1]
    delays = spark.createDataFrame([("93", "10"), ("93", "20"), ("72", "10"), ("x", None)], "delay_code string, delay_duration string")
    shares = {r["delay_code"]: r["minutes_share"] for r in rankings.delay_causes(delays).collect()}
    assert shares == {"93": 0.75, "72": 0.25, "x": 0.0}


def test_search_bounds_are_half_open(spark):
    rows = spark.sql(
        "select 'f' flight_id, 'ZA' airline_code, 7 flight_number, date '2026-01-01' flight_schedule_date, t scheduled_departure"
        " from values (timestamp '2026-01-01 00:00:00'), (timestamp '2026-01-02 00:00:00'), (timestamp '2026-01-20 00:00:00') as v(t)"
    )
    assert search.flight_search(rows, "2026-01-01", "2026-01-02", flight_number=7).count() == 1
    assert search.flight_search(rows, "2026-01-01", "2026-02-01").count() == 3
    assert search.flight_search(rows, "2026-01-01", "2026-02-01", carrier="ZB").count() == 0
    assert search.flight_lookup(rows, "f").count() == 3


def test_dummies_and_one_hot(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c")], "id int, t string")
    got = {r["id"]: (r["t_b"], r["t_c"]) for r in features.dummies(df, "t").collect()}
    assert got == {1: (0.0, 0.0), 2: (1.0, 0.0), 3: (0.0, 0.0), 4: (0.0, 1.0)}
    hot = features.one_hot(df, "t")
    assert set(hot.columns) == {"id", "t_a", "t_b", "t_c", "t___MISSING__"}
    unseen = features.one_hot(df, "t", ["a"])
    assert [r["t_a"] for r in unseen.orderBy("id").collect()] == [1.0, 0.0, 0.0, 0.0]


def test_any_number_of_levels_is_encoded(spark):
    df = spark.range(10_001).select("id", F.concat(F.lit("l"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("t"))
    levels = features.level_table(df.unionByName(spark.createDataFrame([(-1, None)], "id long, t string")), "t")
    got = {r["level"]: r["index"] for r in levels.collect()}
    assert sorted(got.values()) == [*range(10_002)] and [got[k] for k in sorted(got)] == [*range(10_002)]
    coded = features.encode_levels(df.limit(5).withColumn("t", F.when(F.col("id") != 2, F.col("t")).otherwise("unseen")), "t", levels)
    assert {r["id"]: r["t_index"] for r in coded.collect()}[2] is None and coded.columns == ["id", "t_index"]


def test_scaling_of_a_constant_column_gives_zero(spark):
    df = spark.createDataFrame([(2.0, 5.0), (4.0, 5.0), (1050.0, 5.0)], "x double, c double")
    low = features.fit_min_max(df, ["x", "c"]).apply(df).collect()
    assert [r["c"] for r in low] == [0.0] * 3 and low[2]["x"] == 1.0
    mean, std = np.mean([2, 4, 1050]), np.std([2, 4, 1050])
    got = features.fit_standard(df, ["x", "c"]).apply(df).collect()
    assert [r["x"] for r in got] == pytest.approx([(v - mean) / std for v in (2, 4, 1050)])
    assert [r["c"] for r in got] == [0.0] * 3


def test_anova_f_by_hand(spark):
    df = spark.createDataFrame([(0, 1.0, 3.0), (0, 2.0, 3.0), (1, 4.0, 3.0), (1, 7.0, 3.0)], "y int, a double, c double")
    got = {r["feature"]: r["f_value"] for r in features.anova_f(df, ["a", "c"], "y").collect()}
    assert got["a"] == pytest.approx(16.0 / (5.0 / 2)) and got["c"] is None
    assert [r["feature"] for r in features.best_features(df, ["c", "a"], "y", 1).collect()] == ["a"]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    assert {r["y"]: r["weight"] for r in features.class_weights(df, "y").collect()} == {0: 8 / 12, 1: 2.0}
    assert features.add_class_weight(df, "y").agg(F.sum("weight")).first()[0] == pytest.approx(8.0)


@pytest.mark.parametrize("share", [Fraction(1, 5), Fraction(1, 3), Fraction(0), Fraction(1)])
def test_split_is_exact_and_does_not_depend_on_partitions(spark, share):
    df = spark.range(1003).select(F.concat(F.lit("k"), "id").alias("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    split = features.stratified_split(df, "y", "id", share)
    test = {r["y"]: r["n"] for r in split.where("not is_train").groupBy("y").agg(F.count("*").alias("n")).collect()}
    wanted = features.stratified_quotas({0: 902, 1: 101}, share)
    assert test == {k: v for k, v in wanted.items() if v} and sum(wanted.values()) == -(-1003 * share.numerator // share.denominator)
    again = features.stratified_split(df.repartition(3, "id"), "y", "id", share)
    assert split.exceptAll(again).count() == 0


def test_metrics_with_zero_divisors(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    row = metrics.classification_metrics(df).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.5, 0.0, 0.0, 0.0)


def test_auc_by_pairs_and_by_spark(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), round(rng.random(), 1)) for _ in range(300)]
    rows += [(1, 0.5)] * 150  # a third of all rows share one score
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "label int, score double")
    assert metrics.roc_auc(df).first()["auc"] == pytest.approx(want)
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(df)
    assert spark_auc == pytest.approx(want)
    assert metrics.roc_auc(df.where("label = 1")).first()["auc"] is None


def test_totals_below_many_values(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5000).cast("double").alias("v"), F.lit(1).alias("n"))
    got = ordering.totals_below(df, "v", ["n"])
    assert got.where(F.col("below_n") != F.col("v").cast("long")).count() == 0 and got.count() == 5000


def exact_gaps(local):
    m = np.stack(local["vec"])
    gaps = np.array([np.sqrt(((m - row) ** 2).sum(axis=1)) for row in m])
    np.fill_diagonal(gaps, np.inf)
    return dict(zip(local["rep"], np.sort(gaps, axis=1)[:, :5], strict=True))


def test_neighbours_equal_brute_force_in_blocks_of_any_size(spark):
    rng = np.random.default_rng(5)
    vectors = np.round(rng.normal(size=(600, 3)), 1)
    vectors[:200] = vectors[0]  # a third of all points are copies of one
    points = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, vec array<double>")
    distinct = neighbours.distinct_vectors(points, "id", "vec")
    local = distinct.toPandas()
    assert local["copies"].max() >= 200 and local["copies"].sum() == 600
    want = exact_gaps(local)
    for block in (2000, 40):
        found = neighbours.nearest(distinct, 5, block).toPandas()
        assert found["rep"].nunique() == len(local) and (found.groupby("rep").size() == 5).all()
        for rep, group in found.groupby("rep"):
            assert group.sort_values("place")["distance"].to_numpy() == pytest.approx(want[rep])


def test_neighbours_with_hundreds_of_rare_levels(spark):
    rng = np.random.default_rng(6)
    n, carriers, types = 1500, 149, 97
    vectors = np.zeros((n, 9 + carriers + types))
    vectors[:, :9] = rng.normal(size=(n, 9))
    for start, levels in ((9, carriers), (9 + carriers, types)):
        level = np.minimum(rng.geometric(0.05, n) - 1, levels - 1)
        vectors[np.arange(n), start + level] = 1 / np.sqrt(np.bincount(level, minlength=levels)[level] / n)
    points = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, vec array<double>")
    distinct = neighbours.distinct_vectors(points, "id", "vec")
    want = exact_gaps(distinct.toPandas())
    found = neighbours.nearest(distinct, 5).toPandas()
    for rep, group in found.groupby("rep"):
        assert group.sort_values("place")["distance"].to_numpy() == pytest.approx(want[rep])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(neighbours, "MAX_VECTORS", 100)
        with pytest.raises(ValueError):
            neighbours.nearest(distinct, 5)


def test_a_class_with_one_row_is_raised_too(spark):
    rows = [(f"a{i}", [float(i), 0.0], 0) for i in range(7)] + [("b", [5.0, 5.0], 1)]
    balanced = oversample.balance_classes(spark.createDataFrame(rows, "id string, vec array<double>, y int"), "id", "vec", "y").collect()
    assert Counter(r["y"] for r in balanced) == {0: 7, 1: 7} and all(r["vec"] == [5.0, 5.0] for r in balanced if r["y"])


def test_depth_and_fit_rows_hold_for_both_kinds(spark):
    deep = learn.Settings(depth=12)
    assert learn.forest(deep).getMaxDepth() == learn.boosted_trees(deep).getMaxDepth() == 12
    assert learn.forest(learn.Settings()).getMaxDepth() == 30
    rows = spark.range(5000).select(F.col("id").cast("string").alias("leg_id"))
    assert 350 < learn.fit_share(rows, "leg_id", 500, 1).count() < 650 and learn.fit_share(rows, "leg_id", 9000, 1).count() == 5000


def test_oversampling_balances_and_stays_between_points(spark):
    rng = np.random.default_rng(9)
    rows = [(f"a{i}", [float(x) for x in rng.normal(size=2)], 0) for i in range(120)]
    rows += [(f"b{i}", [float(x) for x in rng.normal(size=2) + 20], 1) for i in range(17)]
    df = spark.createDataFrame(rows, "id string, vec array<double>, y int")
    balanced = oversample.balance_classes(df, "id", "vec", "y")
    again = oversample.balance_classes(df.repartition(5), "id", "vec", "y")
    got = balanced.collect()
    assert Counter(r["y"] for r in got) == {0: 120, 1: 120}
    assert len({r["id"] for r in got}) == 240
    low, high = np.min([v for _, v, y in rows if y], axis=0), np.max([v for _, v, y in rows if y], axis=0)
    made = np.array([r["vec"] for r in got if r["is_synthetic"]])
    assert len(made) == 103 and (made >= low - 1e-9).all() and (made <= high + 1e-9).all()
    assert sorted(map(str, got)) == sorted(map(str, again.collect()))


def test_training_scores_every_row_and_survives_a_reload(spark, tmp_path):
    rows = spark.range(600).select(
        F.concat(F.lit("leg"), "id").alias("leg_id"),
        F.lit("f").alias("flight_id"),
        (F.col("id") % 50 == 0).alias("cancelled"),
        (F.col("id") % 5 == 0).alias("is_delayed"),
        F.when(F.col("id") % 5 == 0, 300).otherwise(60).alias("scheduled_flight_duration_min"),
        (F.col("id") % 7).alias("departure_weekday"),
        F.when(F.col("id") % 3 == 0, "ZA").when(F.col("id") % 3 == 1, "ZB").alias("airline_key"),
        F.lit("T1").alias("aircraft_type_code"),
    )
    prepared = learn.training_rows(rows)
    settings = learn.Settings(trees=5, depth=4)
    model, split = learn.train(prepared, settings)
    scored = learn.score(model, split)
    result = learn.evaluate(scored).first()
    assert result["accuracy"] == 1.0 and result["auc"] == 1.0
    table = learn.scored_table(scored)
    assert table.count() == 588 == table.select("leg_id").distinct().count()
    assert table.columns == ["leg_id", "flight_id", "delay_predicted", "delay_probability"]
    assert learn.feature_importance(model).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    model.save(str(tmp_path / "m"))
    reloaded = learn.scored_table(learn.score(learn.load_model(str(tmp_path / "m")), split))
    assert reloaded.exceptAll(table).count() == 0
    boosted, _ = learn.train(prepared, learn.Settings(trees=3, depth=3, oversample=False), "boosted")
    assert learn.evaluate(learn.score(boosted, split)).first()["accuracy"] == 1.0
    top = learn.feature_importance(boosted).orderBy(F.desc("importance")).first()
    assert top["feature"] == "scheduled_flight_duration_min"


@pytest.mark.parametrize("block", [5000, 100, 7])
def test_neighbours_of_any_number_equal_brute_force(spark, block):
    """More vectors than the bounded search takes, in clusters, with rare levels and copies."""
    rng = np.random.default_rng(11)
    n = 1200
    vectors = np.round(rng.normal(size=(n, 4)), 1) + 50.0 * rng.integers(0, 5, n)[:, None]
    vectors[:100] = vectors[0]
    vectors = np.hstack([vectors, np.eye(30)[np.minimum(rng.geometric(0.2, n) - 1, 29)] * 4])
    points = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, vec array<double>")
    distinct = neighbours.distinct_vectors(points, "id", "vec")
    local = distinct.toPandas()
    want = exact_gaps(local)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(neighbours, "MAX_VECTORS", 100)
        found = neighbours.nearest_in_blocks(distinct, 5, block).toPandas()
    by_rep = local.set_index("rep")
    assert found["rep"].nunique() == len(local) and (found.groupby("rep").size() == 5).all()
    for rep, group in found.groupby("rep"):
        assert group.sort_values("place")["distance"].to_numpy() == pytest.approx(want[rep])
    for row in found.head(200).itertuples():
        assert row.rep != row.neighbour and list(row.neighbour_vec) == list(by_rep["vec"][row.neighbour]) and row.neighbour_copies == by_rep["copies"][row.neighbour]


def test_whole_blocks_are_joined_once(spark):
    """Vectors that ask another block leave their own with its scan, not by a second join of whole blocks."""
    points = spark.createDataFrame([(i, [float(i), i % 7.0]) for i in range(60)], "id long, vec array<double>")
    found = neighbours.nearest_in_blocks(neighbours.distinct_vectors(points, "id", "vec"), 5, 20)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 2  # the other block, the neighbours' vectors


def test_few_vectors_in_blocks(spark):
    points = spark.createDataFrame([(1, [0.0, 1.0]), (2, [3.0, 5.0]), (3, [3.0, 5.0])], "id long, vec array<double>")
    found = neighbours.nearest_in_blocks(neighbours.distinct_vectors(points, "id", "vec"), 5).collect()
    assert {(r.rep, r.neighbour, r.distance, r.neighbour_copies, r.place) for r in found} == {(1, 2, 5.0, 2, 1), (2, 1, 5.0, 1, 1)}
    assert neighbours.nearest_in_blocks(neighbours.distinct_vectors(points.limit(1), "id", "vec"), 5).count() == 0
    assert neighbours.nearest_in_blocks(neighbours.distinct_vectors(points.limit(0), "id", "vec"), 5).count() == 0


def test_oversampling_queries_read_every_row(spark):
    """The vectors of the queries are those of all rows, however few a bounded search takes."""
    from suite import learning

    rows = learning.learn.training_rows(learning.mart_fact(spark, "/root/testdata/sf0.001"))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(neighbours, "MAX_VECTORS", 500)
        assert learning._vectors(spark, "/root/testdata/sf0.001").count() == rows.count() > 1000
