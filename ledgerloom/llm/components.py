"""Connected components of a graph of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import cut


def _lower(edges: DataFrame) -> DataFrame:
    """(node, low): the least neighbour of every node, or the node itself where that is less."""
    return cut(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges (u, v) of comparable ids -> (u, root): every node with links and the least node it reaches.

    Each round writes its links to the shared folder, so a lost executor costs one round. Nothing is collected
    but a count and a checksum. Self links and nulls are ignored; no links give no rows.
    """
    edges = edges.filter("u != v")
    links = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        seen = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or seen == state:
            return links.select("u", F.col("v").alias("root"))
        state = seen
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lower(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = cut(large)
        low = _lower(large)
        small = large.join(low, "u").filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        links = cut(small.unionByName(low.select("u", F.col("low").alias("v"))).filter("u != v").distinct())
    raise RuntimeError("components did not settle")
