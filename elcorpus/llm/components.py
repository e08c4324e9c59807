"""Connected components over an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from elcorpus.llm.common import shuffle_parts, written

#: Edges in a partition of a round, at least: small tables take few tasks.
PART_EDGES = 10_000


def _star(edges: DataFrame, large: bool, parts: int) -> DataFrame:
    """One star step over rows (u, v), u > v, in ``parts`` partitions."""
    if large:  # every larger neighbour moves to the smallest node around
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:  # the smaller neighbours and the node itself do
        both = edges
    both = both.repartition(parts, "u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).repartition(parts, "u", "v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node of each node's component, for
    every node with an edge; the rounds grow with the logarithm of the
    number of nodes, and each is a written table."""
    now = written(edges.where(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")

    def state(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = state(now)
    while seen[0]:
        parts = min(shuffle_parts(now.sparkSession), -(-seen[0] // PART_EDGES))
        now = written(_star(_star(now, True, parts), False, parts), "edges")
        got = state(now)
        if got == seen:
            break
        seen = got
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
