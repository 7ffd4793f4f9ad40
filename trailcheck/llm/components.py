"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailcheck.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or the smaller ones and itself) linked to the least of them."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    near = both if large else both.where("v < u")
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    met = near.join(least, "u")
    if large:
        out = met.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        out = met.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.where("a != b").distinct()


def components(links: DataFrame, at: str, name: str) -> DataFrame:
    """(id, component) of every node that has a link; the component is its smallest node.

    ``links`` has columns a and b.  Every round is written to the shared folder ``at``; a node with many links is
    pre-aggregated, and its join is one that Spark splits.  Ends when every node hangs on one root.
    """
    now = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(), f"{name}-links", at)
    for k in range(64):  # the number of rounds grows with the logarithm of the nodes
        seen = now.agg(F.count("b").alias("n"), F.countDistinct("b").alias("d")).first()
        if seen["n"] == seen["d"] and now.join(now.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            break
        now = stored(_star(_star(now, True), False), f"{name}-round-{k}", at)
    else:
        raise RuntimeError(f"the components of {name} were not settled after 64 rounds")
    roots = now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return now.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(roots)
