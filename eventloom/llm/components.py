"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.withColumnRenamed("m", "b")).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node with an edge, where ``root`` is the smallest node of its component.

    ``edges`` has two long columns ``a`` and ``b`` in any direction, repeats and loops allowed. Each round is written
    to the shared work folder; a node with many edges is spread over tasks before it is joined. The number of rounds
    grows with the logarithm of the longest path.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        # A star forest is a fixed point: every node once on the left, and no root among them.
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            break
        mark = tuple(seen)
        now = stored(_small_star(_large_star(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
