"""Connected components of a link table by randomised contraction, all in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; nodes of one component share one root, itself a node.

    Each round maps every node to the neighbour (or itself) whose hash is least and contracts the links;
    the hash changes from round to round, so even a sorted path shrinks by a constant factor, and the
    number of rounds is logarithmic. Loops and repeated links are harmless; null ends are dropped.
    """
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a != b").distinct()
    links = materialize(links, "links")
    maps: list[DataFrame] = []
    while not links.isEmpty():
        rank = lambda c: F.xxhash64(c, F.lit(len(maps)))  # noqa: B023, E731
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min(F.struct(rank(F.col("b")).alias("r"), F.col("b").alias("to"))).alias("n"))
        own = F.struct(rank(F.col("a")).alias("r"), F.col("a").alias("to"))
        step = materialize(nearest.select(F.col("a").alias("node"), F.least("n", own)["to"].alias("to")), "step")
        maps.append(step)
        links = links.join(step.select(F.col("node").alias("a"), F.col("to").alias("a2")), "a")
        links = links.join(step.select(F.col("node").alias("b"), F.col("to").alias("b2")), "b")
        links = materialize(links.select(F.col("a2").alias("a"), F.col("b2").alias("b")).filter("a != b").distinct(), "links")
    if not maps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0].select("node", F.col("to").alias("root"))
    for step in maps[1:]:
        out = out.join(step.select(F.col("node").alias("root"), "to"), "root", "left")
        out = out.select("node", F.coalesce("to", "root").alias("root"))
    return out
