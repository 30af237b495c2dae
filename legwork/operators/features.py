"""Feature columns: levels, scaling, selection, split and weights.

Fitted values (levels, bounds, moments) are small: their size depends on the
number of columns and levels. They are collected once and applied as literals.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwork.functions.values import int_or_zero
from legwork.operators.normalize import add_missing_columns
from legwork.operators.ordering import smallest_hashes

MISSING_LEVEL = "__MISSING__"

# ---- Fixed values: model columns ----
NUMERIC_FEATURES = [
    "scheduled_flight_duration_min",
    "departure_weekday",
    "departure_month",
    "departure_hour",
    "departure_monthday",
    "dep_airport_nb_departing",
    "dep_airport_nb_arriving",
    "arr_airport_nb_departing",
    "arr_airport_nb_arriving",
]
CATEGORICAL_FEATURES = ["airline_key", "aircraft_type_code"]
# ---- End of the model columns ----


def prepare_numeric(df: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Numeric features as whole numbers; an absent column or unreadable value is 0."""
    complete = add_missing_columns(df, {c: "int" for c in columns})
    return complete.withColumns({c: int_or_zero(F.col(c)) for c in columns})


def levels_of(df: DataFrame, column: str) -> list[str]:
    """Sorted levels of a categorical column, null left out.

    For the wide forms below, where each level becomes a column. ``level_table`` and
    ``encode_levels`` do without a list on the driver.
    """
    found = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("v")).distinct()
    return sorted(row["v"] for row in found.collect())


def level_table(df: DataFrame, column: str) -> DataFrame:
    """``level, index`` of a categorical column in text order, null being a level of its own.

    Indexes are dense from 0. Levels are numbered in the buckets of their first character,
    after the counts of the smaller buckets, so no task sees them all.
    """
    levels = df.select(F.coalesce(F.col(column).cast("string"), F.lit(MISSING_LEVEL)).alias("level")).distinct()
    bucketed = levels.withColumn("_bucket", F.substring("level", 1, 1))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    here = F.row_number().over(Window.partitionBy("_bucket").orderBy("level")) - 1
    return bucketed.withColumn("_here", here).join(offsets, "_bucket").select(
        "level", (F.col("_here") + F.col("_before")).cast("int").alias("index")
    )


def encode_levels(df: DataFrame, column: str, levels: DataFrame, name: str | None = None) -> DataFrame:
    """The level's index in place of the column; an unseen level is null. Any number of levels."""
    value = F.coalesce(F.col(column).cast("string"), F.lit(MISSING_LEVEL))
    known = levels.select(F.col("level").alias("_level"), F.col("index").alias("_index"))
    joined = df.join(known, value == F.col("_level"), "left").withColumn(name or f"{column}_index", F.col("_index"))
    return joined.drop("_level", "_index", *([] if name == column else [column]))


def _indicator(column: Column, level: str) -> Column:
    return F.coalesce(column == level, F.lit(False)).cast("double")


def dummies(df: DataFrame, column: str, levels: list[str] | None = None) -> DataFrame:
    """One 0/1 column per level but the first; null is all zeros. The source column goes."""
    levels = levels_of(df, column) if levels is None else levels
    value = F.col(column).cast("string")
    return df.withColumns({f"{column}_{v}": _indicator(value, v) for v in levels[1:]}).drop(column)


def one_hot(df: DataFrame, column: str, levels: list[str] | None = None) -> DataFrame:
    """One 0/1 column per level, null being a level of its own; an unseen level is all zeros."""
    filled = df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit(MISSING_LEVEL)))
    levels = levels_of(filled, column) if levels is None else levels
    return filled.withColumns({f"{column}_{v}": _indicator(F.col(column), v) for v in levels}).drop(column)


@dataclass(frozen=True)
class Scaling:
    """Offset and divisor per column: ``(x - offset) / divisor``."""

    values: dict[str, tuple[float, float]]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: (F.col(c).cast("double") - F.lit(offset)) / F.lit(divisor) for c, (offset, divisor) in self.values.items()}
        )


def _fit(df: DataFrame, columns: list[str], offset, spread) -> Scaling:
    row = df.agg(
        *[offset(c).cast("double").alias(f"o{i}") for i, c in enumerate(columns)],
        *[spread(c).cast("double").alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return Scaling({c: (row[f"o{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)})


def fit_min_max(df: DataFrame, columns: list[str]) -> Scaling:
    """Scale to [0, 1]; a constant column becomes 0."""
    return _fit(df, columns, F.min, lambda c: F.max(c) - F.min(c))


def fit_standard(df: DataFrame, columns: list[str]) -> Scaling:
    """Centre and divide by the population deviation; a constant column becomes 0."""
    return _fit(df, columns, F.avg, F.stddev_pop)


def anova_f(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """F statistic of each feature between the classes of a label.

    One grouped pass takes count, mean and variance of every feature per class,
    with partial combination; the rest works on one row per class.
    """
    per_class = df.groupBy(label).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.var_pop(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(features)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"v{i}").alias("var"))
            for i, c in enumerate(features)
        ]
    )
    long = per_class.select("n", F.explode(entries).alias("e")).select("n", "e.*")
    sums = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("total"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"),
        F.sum(F.col("n") * F.col("var")).alias("within"),
        F.collect_list(F.struct("n", "mean")).alias("classes"),
    )
    between = F.aggregate(
        "classes", F.lit(0.0), lambda acc, c: acc + c["n"] * (c["mean"] - F.col("grand")) * (c["mean"] - F.col("grand"))
    )
    mean_between = between / (F.col("k") - 1)
    mean_within = F.col("within") / (F.col("total") - F.col("k"))
    return sums.select("feature", F.try_divide(mean_between, mean_within).alias("f_value"))


def best_features(df: DataFrame, features: list[str], label: str, k: int = 20) -> DataFrame:
    """The k features with the largest F; a feature without one comes last."""
    return anova_f(df, features, label).orderBy(F.desc_nulls_last("f_value"), "feature").limit(k)


def stratified_quotas(counts: dict, share: Fraction) -> dict:
    """Test rows per class: the share of each class, with the rounding loss given to the largest remainders."""
    total = sum(counts.values())
    wanted = -(-total * share.numerator // share.denominator)
    exact = {label: Fraction(wanted * n, total) for label, n in counts.items()}
    quotas = {label: int(value) for label, value in exact.items()}
    by_remainder = sorted(counts, key=lambda label: (quotas[label] - exact[label], str(label)))
    for label in by_remainder[: wanted - sum(quotas.values())]:
        quotas[label] += 1
    return quotas


def stratified_split(
    df: DataFrame, label: str, key: str, test_share: Fraction = Fraction(1, 5), seed: int = 42
) -> DataFrame:
    """Add ``is_train``: an exact share of each class is set aside for the test."""
    flagged = smallest_hashes(df, key, lambda counts: stratified_quotas(counts, test_share), label, seed, "_is_test")
    return flagged.withColumn("is_train", ~F.col("_is_test")).drop("_is_test")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: n / (classes * n of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every_class = Window.partitionBy()  # one row per class
    balanced = F.sum("n").over(every_class) / (F.count(F.lit(1)).over(every_class) * F.col("n"))
    return counts.select(label, "n", balanced.alias("weight"))


def add_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Attach the balanced weight of its class to each row."""
    weight = F.lit(None).cast("double")
    for row in class_weights(df, label).collect():
        weight = F.when(F.col(label).eqNullSafe(F.lit(row[label])), F.lit(row["weight"])).otherwise(weight)
    return df.withColumn(name, weight)


def sparse_dummies(df: DataFrame, numeric: list[str], categorical: list[str], name: str = "features") -> tuple[DataFrame, list[str]]:
    """The numbers and the dummies of all levels but each column's first, as one sparse vector, and its names.

    A row costs its own levels, however many there are in all; null is all zeros.
    """
    indexed, hot, sliced = ([f"{c}_{kind}" for c in categorical] for kind in ("index", "hot", "dummies"))
    rows = df.withColumns({c: F.col(c).cast("string") for c in categorical})
    indexer = StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc").fit(rows)
    stages = [OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True)]
    names, parts = list(numeric), list(numeric)
    for column, levels, source, target in zip(categorical, indexer.labelsArray, hot, sliced, strict=True):
        if len(levels) > 1:
            stages.append(VectorSlicer(inputCol=source, outputCol=target, indices=list(range(1, len(levels)))))
            names += [f"{column}_{level}" for level in levels[1:]]
            parts.append(target)
    stages.append(VectorAssembler(inputCols=parts, outputCol=name))
    made = indexer.transform(rows)
    return Pipeline(stages=stages).fit(made).transform(made).drop(*indexed, *hot, *sliced), names


def anova_f_sparse(df: DataFrame, features: str, label: str) -> np.ndarray:
    """F statistic of each place of a vector column between the classes of a label.

    One pass sums the vectors and their squares per class; the driver sees two numbers per
    class and place. A place that is constant in every class has no F and is nan.
    """
    moments = Summarizer.metrics("count", "mean", "variance").summary(F.col(features))
    classes = df.groupBy(label).agg(moments.alias("m")).select("m.*").collect()
    n = np.array([c["count"] for c in classes], float)[:, None]
    mean = np.stack([c["mean"].toArray() for c in classes])
    within = sum((c["count"] - 1) * c["variance"].toArray() for c in classes)
    between = (n * (mean - (n * mean).sum(0) / n.sum()) ** 2).sum(0)
    with np.errstate(divide="ignore", invalid="ignore"):
        found = (between / (len(classes) - 1)) / (within / (n.sum() - len(classes)))
    return np.where(within > 0, found, np.nan)


def best_sparse_features(df: DataFrame, numeric: list[str], categorical: list[str], label: str, k: int = 20) -> DataFrame:
    """``feature, f_value`` of the k numbers and dummies with the largest F, in two passes for any number of levels."""
    vectors, names = sparse_dummies(df, numeric, categorical)
    f = anova_f_sparse(vectors, "features", label)
    best = sorted((-v, name) for name, v in zip(names, f.tolist()) if v == v)[:k]
    return df.sparkSession.createDataFrame([(name, -v) for v, name in best], "feature string, f_value double")
