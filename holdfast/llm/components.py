"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import discard, written


def _towards_smallest(links: DataFrame, larger_only: bool) -> DataFrame:
    """Link a node's neighbours with the smallest of them and itself.

    With `larger_only`, the neighbours above the node; else those below, and the node itself.
    """
    if larger_only:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        moved = both.where("b > a").join(least, "a")
        return moved.select(F.col("least").alias("a"), "b").distinct()
    least = links.groupBy("b").agg(F.min("a").alias("least"))
    moved = links.join(least, "b")
    below = moved.where("a > least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return below.union(moved.select(F.col("least").alias("a"), "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of `links` (a, b with a < b); `root` is the component's smallest node.

    Alternates two steps that keep connectedness and pull every node towards the smallest one, until
    nothing moves; the number of rounds grows with the logarithm of a component's extent. Each round is
    written to the shared space, where only the last one stays.
    """
    now, path = written(links)
    state = None
    while True:
        before = path
        now, path = written(_towards_smallest(_towards_smallest(now, True), False))
        discard(links.sparkSession, before)
        seen = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("b")
        ).first()
        # settled: every node has one smaller partner, and another round changed nothing
        if seen == state:
            break
        state = seen
    stars = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.union(now.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
