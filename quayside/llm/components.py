"""Connected components by contraction, with DataFrame joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def followed(step: DataFrame) -> DataFrame:
    """A map of nodes to smaller nodes or themselves, followed to its ends; each join doubles the steps taken."""
    while True:
        after = step.select(F.col("node").alias("to"), F.col("to").alias("end"))
        jumped = durable(step.join(after, "to").select("node", F.col("end").alias("to"), (F.col("end") != F.col("to")).alias("moved")))
        step = jumped.select("node", "to")
        if jumped.where("moved").isEmpty():
            return step


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """`node, component` (the smallest node reachable) for every node of an edge.

    Each round maps every node to the smallest of itself and its neighbours, follows that map to its ends by doubling,
    rewrites the edges by it and drops those that became loops. Only local minima are left, at most half of the nodes, so
    a star or a clique is done in one round and any graph in a number that grows with the logarithm of its size. The minimum is aggregated before it
    is shuffled, and a hub only makes many rows on one side of a plain join, which adaptive execution splits. The maps
    are then chained backwards. Nothing but whether edges are left reaches the driver.
    """
    edges = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a != b")
    edges = durable(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        ends = edges.groupBy("b").agg(F.min("a").alias("to")).select(F.col("b").alias("node"), "to")
        own = edges.select(F.col("a").alias("node"), F.col("a").alias("to"))
        maps.append(durable(ends.unionByName(own).groupBy("node").agg(F.min("to").alias("to"))))
        maps[-1] = step = followed(maps[-1])
        moved = edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("new_a")), "a").join(step.select(F.col("node").alias("b"), F.col("to").alias("new_b")), "b")
        moved = moved.where("new_a != new_b").select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
        edges = durable(moved.distinct())
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
    out = maps.pop().select("node", F.col("to").alias("component"))
    while maps:
        deeper = out.select(F.col("node").alias("to"), "component")
        step = maps.pop()
        out = step.join(deeper, "to", "left").select("node", F.coalesce("component", "to").alias("component"))
    return out
