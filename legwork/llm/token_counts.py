"""Exact histogram of encoded document lengths and what its suffix sums answer.

For a context limit, ``docs_at_least`` and ``tokens_at_least`` of the first length not
below it give the documents that would be cut, and

    truncated_total(limit) = total - tokens_at_least + limit * docs_at_least

the tokens left. Nulls and empty texts have length 0. Ties and repeated rows count as
often as they occur; an empty table gives an empty histogram.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwork.llm.storage import landed
from legwork.llm.tokens import byte_encoder

#: Lengths of one block; suffix sums run in the blocks and over the block totals.
BLOCK = 1024


def token_count(text: Column | str, path: str) -> Column:
    """Number of ids of each text."""

    @F.arrow_udf("bigint")
    def counts(texts: pa.Array) -> pa.Array:
        encoder = byte_encoder(path)
        return pa.array([len(encoder.encode(t.as_py())) // 4 if t.is_valid else 0 for t in texts], pa.int64())

    return counts(text)


def length_histogram(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``length, docs``: documents by encoded length, stored, so that texts are encoded once."""
    lengths = docs.select(token_count(F.col(text), path).alias("length"))
    return landed(lengths.groupBy("length").agg(F.count("*").alias("docs")))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with ``tokens``, ``docs_at_least``, ``tokens_at_least``, ``docs_at_most`` and ``truncated_total``.

    ``truncated_total`` is that of a context limit equal to the row's length.
    """
    rows = histogram.select(
        F.col("length").cast("bigint").alias("length"),
        F.col("docs").cast("bigint").alias("docs"),
        (F.col("length") * F.col("docs")).cast("bigint").alias("tokens"),
        F.floor(F.col("length") / BLOCK).cast("bigint").alias("_block"),
    )
    onward = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("_block").agg(F.sum("docs").alias("_docs"), F.sum("tokens").alias("_tokens"))
    whole = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    later = blocks.select(
        "_block",
        F.coalesce(F.sum("_docs").over(onward), F.lit(0)).alias("_docs_later"),
        F.coalesce(F.sum("_tokens").over(onward), F.lit(0)).alias("_tokens_later"),
        F.sum("_docs").over(whole).alias("_docs_all"),
        F.sum("_tokens").over(whole).alias("_tokens_all"),
    )
    within = Window.partitionBy("_block").orderBy(F.desc("length"))
    sums = (
        rows.withColumns({"_docs_here": F.sum("docs").over(within), "_tokens_here": F.sum("tokens").over(within)})
        .join(later, "_block")
        .withColumns(
            {
                "docs_at_least": F.col("_docs_here") + F.col("_docs_later"),
                "tokens_at_least": F.col("_tokens_here") + F.col("_tokens_later"),
            }
        )
    )
    return sums.select(
        "length",
        "docs",
        "tokens",
        "docs_at_least",
        "tokens_at_least",
        (F.col("_docs_all") - F.col("docs_at_least") + F.col("docs")).alias("docs_at_most"),
        (F.col("_tokens_all") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias(
            "truncated_total"
        ),
    )


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """``context_limit, docs_cut, tokens, tokens_lost`` for any limits; no row where there are no documents."""
    spark = sums.sparkSession
    wanted = spark.createDataFrame([(limit,) for limit in limits], "context_limit bigint")
    over = sums.groupBy().agg(
        *[
            F.struct(
                F.lit(limit).cast("bigint").alias("context_limit"),
                F.coalesce(F.sum(F.when(F.col("length") > limit, F.col("docs"))), F.lit(0)).alias("docs_cut"),
                F.sum(F.least(F.col("length"), F.lit(limit)) * F.col("docs")).alias("tokens"),
                F.coalesce(F.sum(F.when(F.col("length") > limit, (F.col("length") - limit) * F.col("docs"))), F.lit(0)).alias(
                    "tokens_lost"
                ),
            ).alias(f"_{i}")
            for i, limit in enumerate(limits)
        ]
    )
    rows = over.select(F.explode(F.array(*[f"_{i}" for i in range(len(limits))])).alias("r")).select("r.*")
    return wanted.join(rows.where("tokens is not null"), "context_limit")


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """``share, length``: the smallest length that at least this share of documents does not exceed."""
    total = F.col("docs_at_most") + F.col("docs_at_least") - F.col("docs")
    found = sums.groupBy().agg(
        *[F.min(F.when(F.col("docs_at_most") >= F.ceil(total * share), F.col("length"))).alias(f"_{i}") for i, share in enumerate(shares)]
    )
    rows = F.array(*[F.struct(F.lit(float(share)).alias("share"), F.col(f"_{i}").alias("length")) for i, share in enumerate(shares)])
    return found.select(F.explode(rows).alias("r")).select("r.*").where("length is not null")
