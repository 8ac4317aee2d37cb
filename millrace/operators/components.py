"""Connected components: every edge moves towards the smallest neighbour until none changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.versions import cut


def connected(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node): for the nodes of ``edges`` (u, v; numbers or text).

    Rounds of two steps: neighbours that are greater than a node hang on its smallest neighbour (or itself), then those that are smaller do. Minima are
    aggregated before the shuffle, so that a node with very many edges costs a row a task. The number of rounds grows with the logarithm of the nodes.
    """
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        up = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(down.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        if (after := _state(edges)) == state:
            break
        state = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select("v", "v").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
