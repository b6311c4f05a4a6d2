"""Connected components by alternating large-star and small-star steps on an edge table.

Every step groups edges by a node with map-side minima and joins the minimum back, so a node with very many
edges is split by Spark. Each round is written to the shared folder; the driver sees one row of counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _star(edges: DataFrame) -> DataFrame:
    """``u``, ``v`` -> edges from every v to the smallest of u and its neighbours."""
    least = edges.groupBy(F.col("u").alias("__u")).agg(F.min("v").alias("__m"))
    joined = edges.join(least, F.col("u") == F.col("__u")).withColumn("__m", F.least("u", "__m"))
    return joined


def components(edges: DataFrame) -> DataFrame:
    """``a``, ``b`` (long, not null) -> ``node``, ``component`` (the smallest node it reaches) for every node
    that is not itself the smallest. Loops and repeated edges change nothing; no edges give no rows."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        seen = tuple(now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
        if seen == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("__m").alias("v")).where("u <> v").distinct()
        small = _star(large)
        small = (small.select(F.col("v").alias("u"), F.col("__m").alias("v"))
                 .unionByName(small.select("u", F.col("__m").alias("v"))).where("u <> v").distinct())
        now = written(small, "edges")
