"""Connected components of links between ids, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

EDGES_IN_TASK = 50_000


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``: the smallest node it can reach.

    Large-star and small-star rounds in turn: each node's neighbours are tied to the smallest
    one among them, first the larger neighbours, then the smaller ones. What is left is a star
    around each component's smallest node. Groups of neighbours are only ever reduced to a
    minimum, never collected. Each step is written to the shared folder; both sides of a join
    are then read and shuffled, so that Spark can split a busy node.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = stored(edges, "edges")
    count, now = _summary(edges)
    while True:
        # So many tasks write a step: what takes few rows must not take a file for each partition.
        tasks = 1 + count // EDGES_IN_TASK
        # Large star: every larger neighbour u of v moves to the smallest neighbour of v or v.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        least = stored(least.select("n", F.least("m", "n").alias("m")).coalesce(2 * tasks), "edges-least")
        large = edges.join(least, edges["v"] == least["n"]).select("u", F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct().coalesce(tasks), "edges")
        # Small star: the smaller neighbours of u, and u, move to the smallest of them.
        least = stored(large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")).coalesce(tasks), "edges-least")
        small = large.join(least, large["u"] == least["n"])
        small = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        small = stored(small.where("u <> v").distinct().coalesce(2 * tasks), "edges")
        before = now
        count, now = _summary(small)
        if now == before:
            break
        edges = small
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return roots.unionByName(edges.select(F.col("u").alias("node"), F.col("v").alias("component"))).distinct()


def _summary(edges: DataFrame) -> tuple[int, tuple]:
    """The number of edges, and what tells whether two tables hold the same ones: with it two
    sums of hashes below 2^54, which can't overflow."""
    sums = (F.sum(F.shiftrightunsigned(F.xxhash64("u", "v", F.lit(seed)), 10).cast("decimal(38,0)")) for seed in (1, 2))
    count, one, two = edges.agg(F.count("*"), *sums).first()
    return count, (count, one, two)
