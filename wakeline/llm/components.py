"""Connected components by stars: every node ends up linked to the least of its component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.session import checkpointed


def _both(links: DataFrame) -> DataFrame:
    return links.select(F.col("src").alias("a"), F.col("dst").alias("b")).union(links.select("dst", "src"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of ``links``
    (``src``, ``dst``). Links to itself and repeated links do no harm.

    Each round links all greater neighbours of a node to its least one, then all
    smaller ones; both keep components whole. A node's least neighbour is found by partial
    aggregation; a node with very many neighbours meets it in a join that Spark may split.
    """
    edges = links.filter("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    edges, seen = checkpointed(edges), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("root")).union(
                edges.select("dst", "dst").distinct()
            )
        seen = state
        around = _both(edges)
        least = around.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = around.join(least, "a").filter("b > a").select(F.col("b").alias("src"), F.col("m").alias("dst")).distinct()
        least = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(least, "src")
        small = small.select(F.col("dst").alias("src"), F.col("m").alias("dst")).union(small.select("src", "m")).filter("src <> dst")
        edges = checkpointed(small.distinct())
