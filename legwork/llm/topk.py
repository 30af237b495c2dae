"""Exact top-k by inner product through a KD-tree per shard.

Rows are dealt to shards of bounded size. A task splits its shard at medians into a tree
of tight bounding boxes. For a query the greatest product with any point of a box bounds
what the box holds; boxes are visited best first, until no bound reaches the k-th score.
That score is found on one shard first and handed on to all others.

Vectors are scaled and floored to whole numbers, so scores are exact while products stay
below 2**63. Null vectors and those with null or non-finite components take no part; only
vectors of one length meet. Ties go to the smaller id. Equal vectors are all candidates.
Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwork.llm.storage import landed

#: Rows of one shard, queries that meet it in one task, and points of a leaf.
SHARD_ROWS = 8_192
QUERY_ROWS = 2_048
LEAF_ROWS = 64
#: Sums of 64-bit floats are exact below this.
EXACT = float(1 << 52)


class Tree:
    """Median splits on the widest side, with the tight box of every node."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        self.low, self.high, self.children, self.leaves = [], [], [], []
        order = np.argsort(ids, kind="stable")
        self.points, self.ids = points[order], ids[order]
        self._grow(np.arange(len(ids)))
        self.low, self.high = np.array(self.low, float), np.array(self.high, float)

    def _grow(self, rows: np.ndarray) -> int:
        node = len(self.low)
        part = self.points[rows]
        low, high = part.min(0), part.max(0)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        self.leaves.append(None)
        width = high - low
        side = int(width.argmax())
        if len(rows) <= LEAF_ROWS or not width[side]:
            self.leaves[node] = np.sort(rows)
            return node
        half = len(rows) // 2
        split = np.argpartition(part[:, side], half)
        self.children[node] = (self._grow(rows[split[:half]]), self._grow(rows[split[half:]]))
        return node

    def search(self, queries: np.ndarray, own: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per query, ids and scores of its best k here among those that reach ``least``."""
        bounds = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        whole = self.points if np.abs(bounds).max(initial=0) >= EXACT else self.points.astype(float)
        for q, query in enumerate(queries):
            kth, ids, scores = least[q], np.zeros(0, np.int64), np.zeros(0, np.int64)
            exact = query.astype(np.int64) if whole.dtype != float else query
            heap = [(-bounds[q, 0], 0)]
            while heap and -heap[0][0] >= kth:
                node = heapq.heappop(heap)[1]
                if self.children[node]:
                    for child in self.children[node]:
                        if bounds[q, child] >= kth:
                            heapq.heappush(heap, (-bounds[q, child], child))
                    continue
                rows = self.leaves[node]
                found = (whole[rows] @ exact).astype(np.int64)
                near = (found >= kth) & (self.ids[rows] != own[q])
                if not near.any():
                    continue
                ids, scores = np.concatenate([ids, self.ids[rows[near]]]), np.concatenate([scores, found[near]])
                if len(ids) > k:
                    best = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[best], scores[best]
                if len(ids) == k:
                    kth = max(kth, scores.min())
            yield q, ids, scores


def whole_numbers(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``vec_id, vec, size``: floor(scale * component) of the vectors that take part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    usable = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(sound & (F.size(vector) > 0))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))
    return usable.select(F.col(key).cast("bigint").alias("vec_id"), scaled.alias("vec"), F.size(vector).alias("size"))


_OUT = "query_id long, vec_id long, score long"


def _search(k: int):
    def run(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(points) and len(queries):
            tree = Tree(np.stack(points.vec.to_numpy()).astype(np.int64), points.vec_id.to_numpy())
            own = queries.query_id.to_numpy()
            vectors = np.stack(queries.vec.to_numpy()).astype(float)
            for q, ids, scores in tree.search(vectors, own, queries.least.to_numpy(float), k):
                found.append(pd.DataFrame({"query_id": own[q], "vec_id": ids, "score": scores}))
        return pd.concat(found) if found else pd.DataFrame({n: np.zeros(0, np.int64) for n in ("query_id", "vec_id", "score")})

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best per query; each has at most k rows of every shard."""
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(rows: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: per query the k rows of greatest product, its own key left out.

    A shard meets the queries in blocks of ``QUERY_ROWS``, as one task's work.
    """
    points = landed(whole_numbers(rows, key, vector, scale))
    asked = landed(whole_numbers(queries, key, vector, scale).withColumnRenamed("vec_id", "query_id"))
    shards = max(1, -(-points.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // QUERY_ROWS))

    def dealt(column: str, parts: int):
        return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")

    points = points.withColumn("_shard", dealt("vec_id", shards))
    asked = asked.withColumns({"_block": dealt("query_id", blocks), "_home": dealt("query_id", shards)})
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    spread = points.withColumn("_block", every_block)
    group = ["size", "_shard", "_block"]

    def meet(asking: DataFrame) -> DataFrame:
        return spread.groupBy(*group).cogroup(asking.groupBy(*group)).applyInPandas(_search(k), _OUT)

    home = asked.withColumns({"_shard": F.col("_home"), "least": F.lit(float("-inf"))})
    first = landed(_best(meet(home), k))
    kth = first.groupBy("query_id").agg(F.min(F.when(F.col("rank") == k, F.col("score"))).cast("double").alias("_kth"))
    away = F.explode(F.array_remove(F.sequence(F.lit(0), F.lit(shards - 1)), F.col("_home")))
    onward = asked.join(kth, "query_id", "left").withColumns({"_shard": away, "least": F.coalesce("_kth", F.lit(float("-inf")))})
    found = _best(meet(onward).unionByName(first.select("query_id", "vec_id", "score")), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
