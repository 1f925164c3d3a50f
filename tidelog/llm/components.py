"""Connected components of an edge list, by alternating stars.

Each round turns edges towards the smallest neighbour: first those to larger
nodes (large star), then those to smaller ones (small star). The number of edges
never grows and the rounds grow with the logarithm of the component size. A hot
node is never gathered: minima are partial aggregates, and the join that follows
may be split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import materialize


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for all nodes of ``edges`` (longs ``u, v``); the root is the smallest node.

    Loops and repeated edges do not matter; no edges give no rows.
    """
    current = materialize(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    mark = _mark(current)
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(smallest, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        current = materialize(small, "edges")
        after = _mark(current)
        if after == mark:
            break
        mark = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
