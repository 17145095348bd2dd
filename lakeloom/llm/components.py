"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import settle


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges(a, b); component is its smallest node.

    Large-star and small-star steps alternate until every edge points at a smallest node. A round
    shuffles as many rows as there are edges, and the number of rounds grows with the logarithm
    of the longest path. A node with very many neighbours costs no task more than a partial
    minimum: neighbours are never gathered. Empty edges give an empty table; null ends are ignored.
    """
    pairs = settle(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    )
    before = None
    for _ in range(max_rounds):
        both = pairs.select("a", "b").unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Settled, so that the join with it is dealt anew and adaptive execution can split a hub's edges.
        least = settle(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        # Large star: every larger neighbour of a node goes to the smallest of its neighbourhood.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = settle(settle(large.where("a > b")).distinct())
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("a")), F.struct(F.col("b").alias("a")))).alias("x"), "m"
        )
        pairs = settle(small.select("x.a", F.col("m").alias("b")).where("a > b").distinct())
        state = pairs.agg(
            F.count("*").alias("n"),
            F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 30))).alias("h"),
            F.count_distinct("a").alias("d"),
        ).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )
