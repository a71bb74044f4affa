"""Connected components of an edge table by alternating stars, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for all ends of ``edges`` (a, b): the component is its smallest node.

    Large stars hang every larger neighbour of a node on the smallest one it sees, small stars every smaller neighbour;
    both together halve the depth, so a few rounds suffice. Each round is stored. Loops and repeated edges do no harm; a
    component of one node only appears if it has a loop, as itself.
    """
    loops = edges.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(low, "a").where("b > a and b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = stored(small.unionAll(low.select("a", F.col("low").alias("b"))).distinct(), "edges")
    hung = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return hung.unionAll(roots.unionAll(loops).distinct().join(hung.select("node"), "node", "left_anti")).distinct()
