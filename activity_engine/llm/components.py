"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import materialize


def _contract(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (a > b).

    The least neighbours are written before they are joined, so that both sides of a
    join are plain shuffles: Spark splits a node with very many edges.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = materialize(least.select("a", F.least("a", "m").alias("m")), "least")
    large = (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .filter("a <> b").distinct())
    large = materialize(large, "large")
    least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least")
    small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each component, for every node but that one.

    ``edges`` has long columns a and b. Nodes and labels stay in tables; only a
    row count and a checksum of each round reach the driver.
    """
    current = materialize(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen or not mark[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("label"))
        seen = mark
        current = materialize(_contract(current), "edges")
