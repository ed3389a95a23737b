"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators.lineage import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the least node that it is connected with.

    In each round a node learns the least root among its neighbours, its root learns it, too, and then roots take their own
    roots, so distances halve. A round is aggregations and joins by node; what a node gathers is a minimum.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct())
    label = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")))
    while True:
        seen = both.join(label.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("low")).select(F.col("a").alias("node"), "low")
        told = label.join(seen, "node").where("low < root").select(F.col("root").alias("node"), "low")
        low = seen.union(told).groupBy("node").agg(F.min("low").alias("low"))
        new = stored(label.join(low, "node", "left").select("node", F.least("root", F.coalesce("low", "root")).alias("root"), F.col("root").alias("before")))
        up = new.select(F.col("node").alias("root"), F.col("root").alias("top"))
        new = stored(new.join(up, "root", "left").select("node", F.least("root", F.coalesce("top", "root")).alias("root"), "before"))
        if new.where("root < before").isEmpty():
            return new.select("node", "root")
        label = new.select("node", "root")
