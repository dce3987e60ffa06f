"""Measure how a hot key is spread: largest partition share after the operator's shuffle.

    python tools/skew_probe.py [--sf DIR]

A third of all events is moved onto one entity (and one place); the share of
rows in the largest post-shuffle partition is reported for the naive form
and for the form the library uses (64 shuffle partitions, AQE coalescing off
so partitions are the hash partitions).
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def largest_share(df, used: str) -> float:
    """``used`` is an output column of the operator, so the operator is not pruned away."""
    from pyspark.sql import functions as F
    c = df.groupBy(F.spark_partition_id().alias("p"), F.col(used).isNull().alias("u")).count() \
        .groupBy("p").agg(F.sum("count").alias("count"))
    r = c.agg(F.max("count").alias("m"), F.sum("count").alias("n")).first()
    return round(r["m"] / r["n"], 4)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    a = ap.parse_args()
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from aloft.session import local_session
    from aloft.operators import interval, sequence
    spark = local_session(8, 64, extra={"spark.sql.adaptive.coalescePartitions.enabled": "false",
                                        "spark.sql.adaptive.skewJoin.enabled": "false"})
    from aloft.sources.io import read_table
    ev = read_table(spark, f"{a.sf}/events.parquet")
    hot = F.pmod(F.col("event_id"), F.lit(3)) == 0
    sk = ev.withColumn("user_id", F.when(hot, F.lit(-1)).otherwise(F.col("user_id"))) \
           .withColumn("event_type", F.when(hot, F.lit("hot")).otherwise(F.col("event_type")))
    out = {}
    naive = sk.withColumn("prev", F.lag("event_id").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    out["previous_event: window by entity"] = largest_share(naive, "prev")
    for kind in ("timestamp_ntz", "timestamp"):
        typed = sk.withColumn("ts", F.col("ts").cast(kind))
        ours = sequence.with_previous(typed, "user_id", ["ts"], ["event_id"], tie_break=["event_id"], keep_first=True)
        out[f"previous_event: window by (entity, hour), {kind}"] = largest_share(ours, "PREV_event_id")
    left = sk.select("event_id", "event_type", "ts")
    right = sk.select(F.col("event_id").alias("rid"), F.col("event_type").alias("rt"), F.col("ts").alias("rts"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plain = left.hint("shuffle_merge").join(right, (left.event_type == right.rt)
                                            & (right.rts > left.ts - F.expr("INTERVAL 3 HOURS"))
                                            & (right.rts < left.ts - F.expr("INTERVAL 2 HOURS")))
    out["interval join: key + range residual"] = largest_share(plain, "rid")
    binned = interval.interval_join(left, right, "event_type", "rt", "ts", "rts")
    out["interval join: (key, hour bin)"] = largest_share(binned, "rid")
    for k, v in out.items():
        print(f"{k}: largest partition holds {v:.1%} of rows")
    spark.stop()


if __name__ == "__main__":
    main()
