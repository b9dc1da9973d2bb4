"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lens.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its neighbours below it are linked to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    below = joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return below.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge (a, b) of longs; root is the least node of its component.

    Alternates large and small stars until the edges are stars; the number of rounds grows
    with the logarithm of the longest path. Each round is written to the shared folder, so
    a lost executor repeats one round at most. Only a count and a checksum reach the driver.
    """
    kept = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    kept = cut_lineage(kept, "edges")
    before = _signature(kept)
    while before[0]:
        kept = cut_lineage(_small_star(_large_star(kept)), "stars")
        now = _signature(kept)
        if now == before:
            break
        before = now
    roots = kept.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return kept.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
