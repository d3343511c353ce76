"""Connected components by alternating large and small stars: each round is one shuffle, and hubs are joined, not gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select("m", "b").filter("m <> b").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """`edges` have a < b: each b gets its least a, and hands it to its other ones."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    handed = edges.join(least, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return least.select(F.col("m").alias("a"), "b").unionAll(handed).distinct()


def _sum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable) of every node that has an edge (a, b)."""
    edges = staged(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = _sum(edges)
    while True:
        edges = staged(_small_star(_large_star(edges)), "stars")
        now = _sum(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(roots)
