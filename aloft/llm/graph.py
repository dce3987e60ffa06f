"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.session import ensure_checkpoint_dir


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the least node of each component, for all nodes that have an edge.

    Alternating large-star and small-star steps: every step is a grouped minimum
    (partially aggregated before the shuffle) and a join, so no task holds a
    component; each round is checkpointed, and rounds grow with the logarithm of
    the components' diameter."""
    ensure_checkpoint_dir(edges.sparkSession)
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))   # large-star
        large = large.where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        e = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")     # small-star
             .unionByName(least.select("u", F.col("m").alias("v"))).distinct().checkpoint())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007), F.bit_xor(F.xxhash64("v", "u"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
