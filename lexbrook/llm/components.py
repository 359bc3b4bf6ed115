"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: Edges that a task takes at least; fewer edges than that for each partition are put together, so short rounds write few files.
EDGES_IN_TASK = 20_000


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b); root: the least node that it is connected to.

    Each round keeps the components, lets all edges point to smaller nodes and shortens the ways, until
    every node points straight to its root; rounds grow with the logarithm of the longest way. Minima
    are aggregated before the shuffle; joins on a node of very many edges can be split by AQE. Each
    round is checkpointed. No edges: no rows. Loops and repeated edges do no harm.
    """
    e = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark, n = None, e.count()
    while True:
        parts = n // EDGES_IN_TASK + 1
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(2 * parts)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x"))
        e = checkpointed(small.select(F.col("x.u").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct().coalesce(parts))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark, n = now, now[0]
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
