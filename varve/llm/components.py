"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.session import written


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("low"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b), for every node that has one.

    Each round hooks neighbours to the smallest node seen: minima are partial aggregates and the rest are joins, so a
    hub's neighbours never meet in one list. Every round is written, so a lost executor repeats that round at most.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    pairs = written(pairs, "links")
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: neighbours above a node go to the smallest node around it
        large = (
            both.join(_lowest(both), "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
            .distinct()
        )
        # small star: a node and its lower neighbours go to the lowest of these
        joined = large.join(_lowest(large), "a")
        small = (
            joined.select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(joined.select("a", F.col("low").alias("b")))
            .where("a > b")
            .distinct()
        )
        after = written(small, "links")
        # nothing moved: then every node hangs on its component's smallest one
        moved = after.join(pairs, ["a", "b"], "left_anti").limit(1).count()
        if not moved and after.count() == pairs.count():
            break
        pairs = after
    low = after.select(F.col("b").alias("node")).distinct()
    return after.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        low.select("node", F.col("node").alias("component"))
    )
