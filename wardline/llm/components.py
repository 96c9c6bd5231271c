"""Connected components of links by alternating large and small stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.text import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Points neighbours of each node at the least of them: the larger neighbours, or the smaller ones and itself."""
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("hub"), F.least("a", "m").alias("m"))
    moved = near.join(least, near["a"] == least["hub"])
    if large:
        out = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("hub").alias("a"), F.col("m").alias("b"))
        )
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """Least node of each linked node's component: ``node, component``. Links are rows ``a, b`` of two numbers.

    Each round is stored in the shared folder and takes joins on nodes only; rounds grow with the logarithm of the
    longest chain. Repeated and reversed links and links of a node to itself make no difference. A node without
    links has no row.
    """
    edges = staged(links.where(F.col("a") != F.col("b")).select(F.col("a").cast("long"), F.col("b").cast("long")).distinct())
    state = None
    while True:
        edges = staged(_star(_star(edges, large=True), large=False))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
