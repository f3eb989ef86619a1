"""Connected components of a graph of long ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.llm.common import stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(vertex, root) of every vertex of the edges (a, b); the root is the smallest vertex that it reaches.

    Every round moves each edge to a smaller end, and is written to the shared folder. The number of rounds grows with the logarithm
    of the longest path. No edges give no rows; loops and repeated edges are ignored.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # The minima are stored, so that a vertex with very many edges meets them by broadcast, or in a join that Spark can split.
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = stored(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(moved.unionByName(least.withColumnRenamed("m", "b")).distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("b").alias("vertex")).distinct().withColumn("root", F.col("vertex"))
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
