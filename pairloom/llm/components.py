"""Connected components of links, by contraction; no group is ever gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.session import stage


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in the links (a, b); ids of one component share the root.

    In each round every node hooks onto the neighbour that comes first in a fixed random order, or stays if it
    comes first itself, and the links between what is left go on. Such a round removes a constant
    share of the nodes on average, whatever the shape. Each round is written to the shared folder. Null ids
    and links of a node to itself are left out; without links there are no rows.
    """
    spread = lambda c: F.struct(F.xxhash64(F.lit(41), c).alias("at"), F.col(c).alias("id"))
    edges = stage(links.select("a", "b").filter("a != b").distinct(), "links")
    rounds = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(spread("b")).alias("near"))
        hook = least.select(F.col("a").alias("node"), F.least(spread("a"), F.col("near"))["id"].alias("to"))
        hook = stage(hook, "hooks")
        rounds.append(hook)
        ends = lambda side: hook.select(F.col("node").alias(side), F.col("to").alias(f"{side}_to"))
        moved = edges.join(ends("a"), "a").join(ends("b"), "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        edges = stage(moved.filter("a != b").distinct(), "links")
    if not rounds:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    found = rounds[0].select(F.col("node").alias("id"), F.col("to").alias("root"))
    for hook in rounds[1:]:
        found = found.join(hook.withColumnRenamed("node", "root"), "root", "left").select("id", F.coalesce("to", "root").alias("root"))
    return found
