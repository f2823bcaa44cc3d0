"""Connected components by alternating large-star and small-star rounds, all in joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """edges(u, v) -> (node, component), the least id reachable, for each node that has an edge to another node.

    Null ends and loops are dropped; repeated edges do no harm; no edges give no rows.
    """
    small = materialize(edges.select(F.greatest("u", "v").alias("x"), F.least("u", "v").alias("y")).where("x <> y").distinct(), "edges")
    before = None
    while (now := small.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("x", "y"), F.lit(1 << 40)))).first()) != before:
        before = now
        both = small.unionByName(small.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        hooked = large.join(low, "x").where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        small = materialize(hooked.unionByName(low.select("x", F.col("m").alias("y"))).distinct(), "edges")
    return small.select(F.col("x").alias("node"), F.col("y").alias("component")).unionByName(small.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct())
