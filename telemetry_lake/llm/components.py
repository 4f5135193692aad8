"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.tables import stored


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
    ).collect()[0]
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # A stored side keeps the join's own shuffles, whose hot nodes adaptive execution splits.
    lowest = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
    return (
        both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours all move to the smallest of them."""
    lowest = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "low")
    moved = edges.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); a component is its smallest node.

    Edges stay a distributed table; each round is stored, and only its row count and a
    checksum reach the driver. Self links and repeated links do no harm; a link with a null
    end is ignored. The number of rounds grows with the logarithm of a component's size.
    """
    loops = edges.where("u = v").select("u", "v").distinct()
    now = stored(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    before, mark = None, _signature(now)
    while mark != before:
        now = stored(_small_star(stored(_large_star(now), "large")), "small")
        before, mark = mark, _signature(now)
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = now.unionByName(loops).select(F.col("v").alias("node"), F.col("v").alias("component"))
    return (
        members.unionByName(centres).groupBy("node").agg(F.min("component").alias("component"))
    )
