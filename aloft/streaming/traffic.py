"""The hourly traffic rate (A3) over a stream of events.

Same definition as ``operators.traffic.hourly_rate``: events, flagged events,
means and flagged/events per (place, hour of ``ts + lag``).  On a stream the
hour is an event-time tumbling window; the watermark bounds state (an hour
is final once the watermark passes its end) and drops events later than it.
In ``append`` mode each (place, hour) row is emitted once, when final.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.functions.clock import epoch_micros, shift


def hourly_rate_stream(events: DataFrame, place: str, ts: str, flag: str,
                       means: Mapping[str, str] | None = None, lag: str | None = "2 hours",
                       watermark: str = "3 hours", bucket: str = "HOUR_BUCKET", count_name: str = "HOURLY_NUM",
                       flagged_name: str = "HOURLY_NUM_FLAGGED", rate_name: str = "HOURLY_RATE") -> DataFrame:
    """Streaming twin of ``hourly_rate``; works on batch DataFrames too (watermark ignored there)."""
    t = shift(ts, lag) if lag else F.col(ts)
    # watermarks need a zoned timestamp: read the naive wall clock as a UTC instant (zone-free)
    e = events.withColumn("__t", F.timestamp_micros(epoch_micros(t))).withWatermark("__t", watermark)
    aggs = [F.count(F.lit(1)).alias(count_name), F.sum(flag).alias(flagged_name)]
    aggs += [F.avg(c).alias(name) for c, name in (means or {}).items()]
    out = e.groupBy(F.col(place), F.window("__t", "1 hour")).agg(*aggs)
    start = F.timestamp_add("MICROSECOND", F.unix_micros(F.col("window.start")),
                            F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return out.select(place, start.alias(bucket), *[a for a in out.columns if a not in (place, "window")]) \
        .withColumn(rate_name, F.try_divide(F.col(flagged_name).cast("double"), F.col(count_name)))
