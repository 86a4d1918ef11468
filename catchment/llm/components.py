"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.session import pin

#: Edges of a file, unless cores would be idle: each file costs a task and, on a local disk, a process that sets its mode.
FILE_EDGES = 1 << 18


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) of each node of `edges` (a, b); the component is its smallest node.

    Each round points every node's larger neighbours, then its smaller ones, to the smallest neighbour. A node's minimum
    is worked out before the shuffle and joined back, so a node with many edges is not gathered in one place.
    """
    found = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    found = pin(found)
    # A round never has more edges than the one before it.
    files = max(edges.sparkSession.sparkContext.defaultParallelism, -(-found.count() // FILE_EDGES))
    for _ in range(rounds):
        both = found.unionByName(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        small = pin(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct().coalesce(files))
        # Done when the edges stay the same: then they are stars around the smallest nodes.
        changed = small.exceptAll(found).limit(1).count() or found.exceptAll(small).limit(1).count()
        found = small
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    nodes = found.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(found.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
