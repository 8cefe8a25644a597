"""Connected components of a graph held in a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierlake import scratch


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """Smallest node that each node of ``edges(a, b)`` can reach, as (node, root).

    Large-star and small-star steps in turn hang every node under a smaller one until only stars
    are left. Each step is one aggregate with map-side combine and one join; the edges between
    steps lie in the shared folder, so lost executors cost one step at most and no link is ever
    held by the driver. Self-loops and repeated edges are allowed; no edges give no rows. ``rows`` is
    about how many edges there are at most, if known.
    """
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    down, last = scratch.stored(down, "edges", rows), None
    while (now := _state(down)) != last:
        last = now
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = scratch.stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges", last[0])
    roots = down.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return down.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u))")).first())
