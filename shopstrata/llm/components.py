"""Connected components of links held in a table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shopstrata.llm.common import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours point at the least node around it."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours point at the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return least.select("a", F.col("least").alias("b")).union(moved).distinct()


def roots(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """For links (a long, b long): one row (a, b) per node that is not the least of its component, b being the least.

    Every round is written to the shared folder. Rounds grow with the logarithm of the longest chain; links that
    have not settled after `most_rounds` raise an error rather than return wrong components. No links, no rows.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = written(edges, "links"), None
    for _ in range(most_rounds):
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return edges
        before = mark
        edges = written(_small_star(_large_star(edges)), "links")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
