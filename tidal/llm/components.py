"""Connected components of an edge table by alternating large-star and small-star steps.

Edges stay in Spark: each step is a partial-aggregated minimum per node and a join of that minimum
back to the edges, which adaptive execution may split for a node with very many edges. Each round
is written to the shared folder. No step collects a neighbourhood.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidal.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above a node is tied to the least of the node and its neighbours."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lower neighbours are tied to the least of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("u", "v").cast("bigint")).alias("a"),
                    F.bit_xor(F.xxhash64("u", "v")).alias("b")).first()
    return row["n"], row["a"], row["b"]


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node with an edge; component is the least node reachable.

    Null ends and loops are ignored; an empty edge table gives no rows. ``max_rounds`` only guards
    against an endless loop (the rounds needed grow with the logarithm of the input) and raises.
    """
    e = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where(
        F.col(u).isNotNull() & F.col(v).isNotNull()).where("u <> v").distinct()
    e = written(e, "edges")
    state = _state(e)
    for _ in range(max_rounds):
        e = written(_small_star(_large_star(e)), "stars")
        now = _state(e)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
