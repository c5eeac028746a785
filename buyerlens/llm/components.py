"""Connected components of an edge table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.base import cut

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, root)`` for every id in ``edges``; root is the smallest id reachable.

    Alternating large-star and small-star rounds: each node's neighbours are
    linked to the smallest of them until every component is a star. A round is
    two grouped minima and two joins; the minima combine before the shuffle and
    AQE splits the joins on a hot node. Null ends and self-loops are ignored.
    """
    e = (edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("lo") < F.col("hi"))).distinct())
    e = cut(e)
    seen = None
    for _ in range(MAX_ROUNDS):
        e = cut(_small_star(_large_star(e)))
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("lo", "hi")), F.sum(F.xxhash64("lo", "hi") % 1000003)).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    members = e.select(F.col("hi").alias("id"), F.col("lo").alias("root"))
    return members.unionByName(e.select(F.col("lo").alias("id"), F.col("lo").alias("root")).distinct())


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or the node)."""
    both = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
        e.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).join(low, "u")
            .select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    low = e.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = e.join(low, "hi").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    own = low.select(F.col("m").alias("lo"), "hi")
    return moved.unionByName(own).where(F.col("lo") < F.col("hi")).distinct()
