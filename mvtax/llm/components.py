"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mvtax.llm.common import Scratch, checkpoint

MAX_ROUNDS = 64


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (columns ``a``, ``b``); root is the component's least node.

    Each round every node points to the least node around it, the pointers are followed twice, and the
    edges move to the nodes pointed to; all nodes but local minima vanish, so the table shrinks
    geometrically. At the end the rounds' pointers are composed. Rows move by joins and partial
    aggregation; a node with very many edges is split by the adaptive skew join, and no neighbour list is
    gathered. Rounds are tables in the shared folder, dropped at the end."""
    with Scratch(edges.sparkSession) as scratch:
        turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        both = scratch.table(edges.select("a", "b").unionByName(turned).filter("a <> b").distinct())
        maps: list[DataFrame] = []
        while not both.isEmpty():
            if len(maps) == MAX_ROUNDS:
                raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
            point = scratch.table(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to")))
            up = point.select(F.col("node").alias("to"), F.col("to").alias("up"))
            point = scratch.table(point.join(up, "to").select("node", F.col("up").alias("to")))
            pa = point.select(F.col("node").alias("a"), F.col("to").alias("ta"))
            pb = point.select(F.col("node").alias("b"), F.col("to").alias("tb"))
            both = scratch.table(both.join(pa, "a").join(pb, "b").filter("ta <> tb").select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct())
            maps.append(point)
        if not maps:
            return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
        found = maps.pop().select("node", F.col("to").alias("root"))
        while maps:
            later = found.select(F.col("node").alias("to"), "root")
            found = maps.pop().join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
        found = scratch.table(found)
        least = found.groupBy("root").agg(F.min("node").alias("least"))
        return checkpoint(found.join(least, "root").select("node", F.col("least").alias("root")))
