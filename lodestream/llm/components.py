"""Connected components by large-star and small-star rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm._common import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours and itself are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(low, "u").filter("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return linked.union(low.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node``, ``component`` (the component's smallest node) for every node of the edges (a, b), a <> b.

    Edges may repeat and stand in either direction; nulls and loops are no
    edges.  Rounds go on until every node is linked to its root; each is
    written to the checkpoint folder, and only a count comes to the driver.
    """
    now = cut_lineage(edges.select("a", "b").filter("a <> b").distinct())
    state = None
    for _ in range(max_rounds):
        now = cut_lineage(_small_star(_large_star(now)))
        # Each link is (root, node) once the stars are stable; the sums tell whether a round changed anything.
        new = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)
