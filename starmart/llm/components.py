"""Connected components of a graph of long node ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (columns a, b) but the roots themselves; the root is the component's smallest id.

    Each turn links every node's larger neighbours to its smallest neighbour, then every node and its smaller
    neighbours likewise. Minima are partial sums and the joins are plain, so adaptive execution splits a hub's rows; every
    turn is written to the shared folder. The number of turns grows with the logarithm of a component's width.
    """
    now = stored(_down(edges).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")).select("e.a", F.col("e.m").alias("b"))
        now = stored(_down(small).distinct(), "edges")
        state, before = _state(now), state
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _down(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
