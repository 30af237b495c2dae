"""Quantiles and distinct counts that merge: per day once, over any span later.

Sketches are columns of binary values of bounded size, so a day's row can be stored and any
span of days is one small aggregate over them. ``exact_quantiles`` uses a sketch to know
where to look and counts to be sure.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a quantile sketch; its ranks err by at most about ``RANK_ERROR`` of the rows, 99 times of 100.
KLL_SIZE, RANK_ERROR = 2000, 0.0025
#: Size of a distinct sketch, as a power of two. Its relative error is about 1.04 / sqrt(2**12),
#: 1.6 %, and up to some hundred values none; three times that is not to be expected.
HLL_SIZE, DISTINCT_ERROR = 12, 0.049
#: Different values that are few enough to be ranked on the driver.
FEW = 10_000


def daily_quantile_sketches(df: DataFrame, day: str, column: str) -> DataFrame:
    """``day, n, low, high, sketch`` of the column's values."""
    value = F.col(column).cast("double")
    return df.where(value.isNotNull()).groupBy(day).agg(
        F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.kll_sketch_agg_double(value, KLL_SIZE).alias("sketch")
    )


def sketched_quantiles(sketches: DataFrame, probabilities: list[float], by: list[str] | None = None) -> DataFrame:
    """``by, n, q0, q1, ...`` over all days of the sketches; each rank errs by ``RANK_ERROR`` of ``n``."""
    merged = sketches.groupBy(*(by or [])).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", KLL_SIZE).alias("_s"))
    found = [F.kll_sketch_get_quantile_double("_s", F.lit(p)).alias(f"q{i}") for i, p in enumerate(probabilities)]
    return merged.select(*(by or []), "n", *found)


def daily_distinct_sketches(df: DataFrame, day: str, columns: list[str]) -> DataFrame:
    """``day, column_name, has_null, sketch``: the different values of each column on each day."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.col(day), F.inline(pairs))
    return values.groupBy(day, "column_name").agg(
        F.max(F.col("value").isNull()).alias("has_null"), F.hll_sketch_agg("value", HLL_SIZE).alias("sketch")
    )


def distinct_over(sketches: DataFrame, by: list[Column | str] | None = None) -> DataFrame:
    """``by, column_name, n_values`` over all days of the sketches; null counts as one value."""
    merged = sketches.groupBy(*(by or []), "column_name").agg(
        F.max("has_null").alias("_null"), F.hll_union_agg("sketch", False).alias("_s")
    )
    count = F.coalesce(F.hll_sketch_estimate("_s"), F.lit(0)) + F.col("_null").cast("int")
    return merged.withColumn("n_values", count.cast("bigint")).drop("_null", "_s")


def _brackets(df: DataFrame, ranks: list[int], n: int) -> dict[int, tuple[float, float]]:
    """For each rank (from 0) the values between which it lies, by a sketch and its error."""
    sketch = df.agg(F.kll_sketch_agg_double("value", KLL_SIZE).alias("s"))
    bounds = [(max(0.0, r / n - 2 * RANK_ERROR), min(1.0, (r + 1) / n + 2 * RANK_ERROR)) for r in ranks]
    asked = [F.kll_sketch_get_quantile_double("s", F.lit(p)) for pair in bounds for p in pair]
    found = sketch.select(F.array(*asked).alias("q")).first()["q"]
    return {r: (found[2 * i], found[2 * i + 1]) for i, r in enumerate(ranks)}


def values_at(df: DataFrame, column: str, ranks: list[int], few: int = FEW) -> dict[int, float]:
    """The values at the ranks (from 0) of the ascending non-null values of a column, exact.

    A sketch names two values around each rank; one pass counts the rows below the first and
    those up to the second, which tells whether the rank lies between and which rank it is
    there. The rows between are narrowed again until ``few`` different values are left. Each
    pass leaves about a hundredth of the rows, and no task or driver ever holds more than
    ``few`` different values. Where a sketch errs beyond its bound, the counts show it, and
    all values on that side are searched.
    """
    rows = df.select(F.col(column).cast("double").alias("value")).where("value is not null and not isnan(value)")
    wanted = {r: (r, -math.inf, math.inf) for r in ranks}
    found: dict[int, float] = {}
    while wanted:
        spans = sorted({(low, high) for _, low, high in wanted.values()})
        for low, high in spans:
            mine = {r: inner for r, (inner, a, b) in wanted.items() if (a, b) == (low, high)}
            here = rows.where((F.col("value") >= low) & (F.col("value") <= high))
            size = here.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("value").alias("d")).first()
            if size["d"] <= few // 2:
                counted = here.groupBy("value").count().orderBy("value").collect()
                for r, inner in mine.items():
                    below = 0
                    for row in counted:
                        below += row["count"]
                        if inner < below:
                            found[r] = row["value"]
                            break
                for r in mine:
                    del wanted[r]
                continue
            brackets = _brackets(here, sorted(mine.values()), size["n"])
            measures = []
            for inner, (a, b) in brackets.items():
                measures += [F.count_if(F.col("value") < a), F.count_if(F.col("value") <= b), F.count_if(F.col("value") == a)]
            counts = here.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures)]).first()
            for i, (inner, (a, b)) in enumerate(brackets.items()):
                below, upto, same = counts[3 * i], counts[3 * i + 1], counts[3 * i + 2]
                for r in [r for r, x in mine.items() if x == inner]:
                    if below <= inner < below + same:
                        found[r] = a
                        del wanted[r]
                    elif below <= inner < upto:
                        wanted[r] = (inner - below, a, b)
                    elif inner < below:
                        wanted[r] = (inner, low, math.nextafter(a, -math.inf))
                    else:
                        wanted[r] = (inner - upto, math.nextafter(b, math.inf), high)
    return found


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float], few: int = FEW) -> dict[float, float | None]:
    """Quantiles of a column's values, interpolated between neighbours as ``percentile`` does."""
    n = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).count()
    if not n:
        return dict.fromkeys(probabilities)
    places = {p: Fraction(str(p)) * (n - 1) for p in probabilities}
    values = values_at(df, column, sorted({f(x) for x in places.values() for f in (math.floor, math.ceil)}), few)
    result = {}
    for p, x in places.items():
        low, high = values[math.floor(x)], values[math.ceil(x)]
        result[p] = low + float(x - math.floor(x)) * (high - low)
    return result


def describe_exact(df: DataFrame, column: str, few: int = FEW) -> DataFrame:
    """Count, mean, spread and exact quartiles of the positive values, with no large state in one task."""
    positive = df.where(F.col(column) > 0)
    quartiles = exact_quantiles(positive, column, [0.25, 0.5, 0.75], few)
    value = F.col(column)
    return positive.agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).cast("double").alias("min"),
        *[F.lit(quartiles[p]).cast("double").alias(name) for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))],
        F.max(value).cast("double").alias("max"),
    )
