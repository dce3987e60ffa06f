"""The flagship query: delay rate by the previous event's status and the lagged traffic level.

events -> previous event of the same entity (J1) -> traffic of the place two
hours earlier (J3) -> P(delayed | previous delayed, busy hour) (A16).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.operators import clean, profile, sequence, traffic
from aloft.plans import bindings as b


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = b.flights(spark, sf_dir)
    lagged = traffic.with_lagged_rate(ev, "event_type", "ts", "delayed", lag="2 hours",
                                      count_name="hourly_n", flagged_name="hourly_delayed", rate_name="hourly_rate")
    lagged = clean.fill_null(lagged, 0, ["hourly_n", "hourly_rate"])
    prev = sequence.with_previous(lagged, "user_id", ["ts"], ["delayed"], prefix="prev_", tie_break=["event_id"])
    busy = prev.withColumn("busy_hour", (F.col("hourly_rate") >= 0.25).cast("int"))
    r = profile.rate_by(busy, ["prev_delayed", "busy_hour"], "delayed")
    return r.select("prev_delayed", "busy_hour", "n", "n_flagged", F.round("rate", 6).alias("rate"))
