"""Connected components of a link table by alternating large and small stars.

Every step is a map-side minimum per node and a join back, so the neighbours of
a node are never gathered in one task; a hub is split by the adaptive skew join.
Each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import discard, written

_EDGE = "a long, b long"


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    met = down.join(least, "a")
    moved = met.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of every node of the link table (a, b)."""
    edges = written(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _fingerprint(edges)
    while before[0]:
        old, edges = edges, written(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        discard(old)
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
