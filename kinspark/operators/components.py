"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspark.session import durable


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` to ``(node, component)``, the component being its least node.
    Work per round is one aggregation and one join over the edges, whatever the
    size of a component."""
    both = edges.filter("a <> b").select("a", "b")
    star = durable(both.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    for _ in range(max_rounds):
        # Large star: all larger neighbours of a node point to its least neighbour.
        sym = star.unionByName(star.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = sym.groupBy("v").agg(F.min("u").alias("n")).select("v", F.least("n", "v").alias("m"))
        large = sym.filter("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).filter("v <> u").distinct()
        # Small star: all smaller neighbours and the node itself point to the least.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(low.select("v", F.col("m").alias("u"))).filter("v <> u").distinct()
        new = durable(small)
        same = new.count() == star.count() and new.join(star, ["v", "u"], "left_anti").isEmpty()
        star = new
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    return star.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(star.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
