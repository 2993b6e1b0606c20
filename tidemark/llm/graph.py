"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of longs -> node, root: the least node reachable.

    Large-star and small-star steps in turn, each one aggregation and one join,
    until no edge changes: a number of rounds logarithmic in the nodes.  A hub's
    minimum is combined map-side and joined back, so no node's neighbours ever
    meet in one task.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.where("a <> b").distinct(), "large")
        down = staged(large.groupBy("a").agg(F.min("b").alias("m")), "down")
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            down.select("a", F.col("m").alias("b")))
        now = staged(small.where("a <> b").distinct(), "small")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
