"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwork.llm.storage import landed


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node reachable from each node of the links ``a, b``.

    Labels spread along links and jump to the label of the node they name, so a chain takes
    about the logarithm of its length in rounds. Each round is stored; a hub's links are
    combined before they move.
    """
    both = landed(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = landed(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, labels.node == near.a).select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        names = labels.select(F.col("node").alias("named"), F.col("label").alias("jump"))
        found = landed(
            spread.join(names, spread.label == names.named).select("node", F.least("label", "jump").alias("label"), "was")
        )
        labels = found.select("node", "label")
        if found.where("label < was").isEmpty():
            return labels
