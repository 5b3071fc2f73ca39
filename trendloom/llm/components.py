"""Connected components of an edge table, without bringing any of it to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.sources.workspace import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of node and neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # stored, so that both sides of the join are shuffled and a hub's edges can be split
    least = materialise(least, "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for the nodes of ``links`` (u, v, both bigint): root is the smallest.

    Rounds of large and small stars until no edge changes; each round is written to the
    shared folder, so a lost executor costs one round at most. Self-links and repeated
    links do no harm. No links give no rows.
    """
    edges = materialise(links.select("u", "v").where("u <> v").distinct(), "links")
    mark = None
    for _ in range(most_rounds):
        edges = materialise(_small_star(_large_star(edges)).where("u <> v").distinct(), "links")
        now = edges.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(v % 1000003)")
        ).first()
        if tuple(now) == mark or not now[0]:
            break
        mark = tuple(now)
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
