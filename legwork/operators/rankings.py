"""Delay rankings by airline, airport, flight and cause."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwork.operators.ordering import ranked


def _delay_stats(minutes: str = "delay_duration_minutes") -> list[Column]:
    value = F.coalesce(F.col(minutes), F.lit(0))
    return [
        F.count(F.lit(1)).alias("nb_legs"),
        F.avg(value).alias("mean_delay"),
        F.avg(F.col("is_delayed").cast("int")).alias("delay_rate"),
        F.stddev_samp(value).alias("volatility"),
    ]


def airline_ranking(fact: DataFrame) -> DataFrame:
    """Airlines by mean delay, most punctual first."""
    stats = fact.where(F.col("airline_key").isNotNull()).groupBy("airline_key").agg(*_delay_stats())
    return ranked(stats, "mean_delay", "punctuality_rank")


def airport_ranking(fact: DataFrame) -> DataFrame:
    """Airports in both roles by mean delay. Each leg counts once per role."""
    roles = F.array(
        F.struct(F.lit("departure").alias("role"), F.col("departure_airport_key").alias("airport_key")),
        F.struct(F.lit("arrival").alias("role"), F.col("arrival_airport_key").alias("airport_key")),
    )
    stats = (
        fact.select("delay_duration_minutes", "is_delayed", F.explode(roles).alias("r"))
        .where(F.col("r.airport_key").isNotNull())
        .groupBy("r.role", "r.airport_key")
        .agg(*_delay_stats())
    )
    return ranked(stats, "mean_delay", "punctuality_rank", ["role"])


def chronic_flights(fact: DataFrame, min_legs: int = 5, min_rate: float = 0.2, by: list[str] | None = None) -> DataFrame:
    """Flight numbers (or routes) that are late again and again."""
    keys = by or ["airline_key", "flight_number"]
    return (
        fact.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("nb_legs"),
            F.sum(F.col("is_delayed").cast("int")).alias("nb_delayed"),
            F.avg(F.col("is_delayed").cast("int")).alias("delay_rate"),
        )
        .where((F.col("nb_legs") >= min_legs) & (F.col("delay_rate") >= min_rate))
    )


def delay_causes(delays: DataFrame) -> DataFrame:
    """Delays and minutes per code with their share of all minutes."""
    minutes = F.coalesce(F.col("delay_duration").try_cast("int"), F.lit(0))
    per_code = delays.groupBy("delay_code").agg(
        F.count(F.lit(1)).alias("nb_delays"), F.sum(minutes).alias("total_minutes")
    )
    all_minutes = per_code.agg(F.nullif(F.sum("total_minutes"), F.lit(0))).scalar()
    return per_code.withColumn("minutes_share", F.col("total_minutes") / all_minutes)
