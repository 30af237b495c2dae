"""Models that must find what was planted, and features from sparse vectors."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from legwork.operators import features
from legwork.plans import learn


@pytest.fixture(scope="module")
def rows(spark):
    """Legs that are late mostly where the hour is late or the carrier is LATE, among noise."""
    noise = lambda i, n: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(n)).cast("int")
    base = spark.range(0, 1600, 1, 4).select(
        F.concat(F.lit("leg"), "id").alias("leg_id"), F.lit("f").alias("flight_id"),
        *[noise(i, 24).alias(name) for i, name in enumerate(features.NUMERIC_FEATURES)],
        F.when(noise(20, 5) == 0, "LATE").otherwise(F.concat(F.lit("C"), noise(21, 6))).alias("airline_key"),
        F.concat(F.lit("T"), noise(22, 9)).alias("aircraft_type_code"), noise(23, 10).alias("_flip"),
    )
    late = ((F.col("departure_hour") >= 17) | (F.col("airline_key") == "LATE")).cast("int")
    return base.withColumn("label", F.when(F.col("_flip") == 0, 1 - late).otherwise(late)).drop("_flip")


SETTINGS = learn.Settings(trees=20, rounds=40, depth=4, validation_share=Fraction(1, 5))


def test_both_models_rank_far_above_chance_on_one_test_share(rows):
    found = {r.kind: r for r in learn.compare(rows, SETTINGS).collect()}
    assert set(found) == {"forest", "boosted"}
    assert all(r.auc >= 0.8 and r.f1 >= 0.7 for r in found.values())
    share = {r.tp + r.fp + r.tn + r.fn for r in found.values()}
    assert share == {320} and found["forest"].nb_trees == 20
    assert 1 <= found["boosted"].nb_trees < 40  # stopped by its validation rows


def test_planted_features_come_first(rows):
    model, _ = learn.train(rows, SETTINGS)
    order = [r.feature for r in learn.feature_importance(model).orderBy(F.desc("importance")).collect()]
    assert set(order[:2]) == {"departure_hour", "airline_key_LATE"}


def test_more_fitted_rows_do_not_harm(rows):
    few, _ = learn.train(rows, learn.Settings(trees=10, depth=4, max_fit_rows=100))
    split = learn.train(rows, learn.Settings(trees=10, depth=4))
    auc = [learn.evaluate(learn.score(m, split[1])).first().auc for m in (few, split[0])]
    assert few.fit_rows < 200 and auc[1] >= auc[0] - 0.02


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_models_are_fitted_on_the_whole_training_share(spark, kind):
    """Also where it is larger than any bound on fitted rows that a default might set."""
    noise = lambda i, n: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(n)).cast("int")
    legs = spark.range(0, 8_000, 1, 4).select(
        F.concat(F.lit("leg"), "id").alias("leg_id"), F.lit("f").alias("flight_id"),
        *[noise(i, 24).alias(name) for i, name in enumerate(features.NUMERIC_FEATURES)],
        F.concat(F.lit("C"), noise(21, 3)).alias("airline_key"), F.lit("T").alias("aircraft_type_code"),
        (noise(22, 4) == 0).cast("int").alias("label"),
    )
    model, split = learn.train(legs, learn.Settings(trees=4, rounds=2, depth=2, oversample=False), kind)
    assert model.fit_rows == split.where("is_train").count() == 6_400


def test_a_forest_fitted_in_parts_is_one_model(rows, tmp_path, monkeypatch):
    monkeypatch.setattr(learn, "SMALL_FIT", 0)
    settings = learn.Settings(trees=10, depth=4)
    model, split = learn.train(rows, settings)
    assert model.classifier.getNumTrees == len(model.classifier.trees) == 10 and model.classifier.getMaxDepth() == 4
    assert len({t.toDebugString for t in model.classifier.trees}) == 10  # no part repeats another's trees
    assert sum(model.classifier.featureImportances.toArray()) == pytest.approx(1)
    model.save(str(tmp_path))
    scores = [{r.leg_id: r.delay_probability for r in learn.score(m, split).collect()} for m in (model, learn.load_model(str(tmp_path)))]
    assert scores[0] == pytest.approx(scores[1]) and len(scores[0]) == 1600


def test_tasks_of_a_fit_grow_with_the_rows_only_where_one_cannot_hold_them(rows):
    assert learn._tasks(rows, 36_000, "forest") == 1 and learn._tasks(rows, 20_000_000, "forest") == 100
    assert learn._tasks(rows, 36_000, "boosted") == rows.sparkSession.sparkContext.defaultParallelism
    assert learn._tasks(rows, 20_000_000, "boosted") == 100 and learn._tasks(rows, 0, "forest") == 1
    assert learn._tasks(rows, 1_500, "forest") == 3


def test_split_is_by_key(rows):
    """The rows set aside do not depend on the order or the partitions of the input."""
    split = lambda df: {r.leg_id for r in features.stratified_split(df, "label", "leg_id").where("not is_train").collect()}
    assert split(rows) == split(rows.repartition(7).orderBy(F.desc("leg_id"))) and len(split(rows)) == 320


def test_best_of_ten_thousand_levels(spark):
    df = spark.range(0, 20_000, 1, 4).select(
        (F.col("id") % 2 == 0).alias("late"), F.concat(F.lit("v"), F.col("id") % 10_000).alias("code"),
        (F.col("id") % 2 + F.col("id") % 3).cast("double").alias("x"), F.lit(5.0).alias("same"),
    )
    best = features.best_sparse_features(df, ["x", "same"], ["code"], "late", 20).collect()
    assert len(best) == 20 and best[0].feature == "x" and "same" not in {r.feature for r in best}
    few = df.withColumn("code", F.when(F.length("code") > 3, None).otherwise(F.col("code")))
    wide = features.dummies(few, "code")
    want = {r.feature: r.f_value for r in features.best_features(wide, [c for c in wide.columns if c != "late"], "late", 500).collect() if r.f_value is not None}
    got = {r.feature: r.f_value for r in features.best_sparse_features(few, ["x", "same"], ["code"], "late", 500).collect()}
    assert got == pytest.approx(want) and len(got) > 50


def test_one_level_and_null_levels(spark):
    df = spark.createDataFrame([(True, "a", 1.0), (False, None, 2.0), (True, "a", 1.5), (False, "a", 2.5)], "late boolean, c string, x double")
    assert [r.feature for r in features.best_sparse_features(df, ["x"], ["c"], "late").collect()] == ["x"]
