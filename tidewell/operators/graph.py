"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return both.where("b > a").join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    tied = down.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def stars(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of any graph as (a, b): b the least node of a's component, a each other node of it.

    Rounds grow with the logarithm of the largest component. Each is written
    to the shared folder; two numbers per round reach the driver.
    """
    edges, before = cut_lineage(edges.where("a != b").select("a", "b").distinct()), None
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges
        before = now
