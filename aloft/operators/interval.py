"""Interval join (J7): right rows whose clock lies inside a window relative to the left clock.

Spark has no interval-join operator; a join on the key with the time range
as a residual compares every pair of a key, which is quadratic for a hot
key.  Here time is cut into bins: each right row lands in exactly one bin
and each left row is expanded to the (distinct) bins its window touches,
so the join is an equi-join on (key, bin) followed by the exact range
test.  No pair is produced twice, and a hot key is spread over its bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aloft.functions.clock import epoch_micros, floor_div, shift

# Microseconds per unit of a simple interval literal.
_UNIT_US = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000}


def interval_us(interval: str) -> int:
    """Microseconds of a simple day-time literal such as ``"1 hour"`` or ``"-90 minutes"``."""
    n, unit = interval.split()
    unit = unit.lower().rstrip("s")
    if unit not in _UNIT_US:
        raise ValueError(f"unsupported interval unit in {interval!r}")
    return int(round(float(n) * _UNIT_US[unit]))


def _bin(ts: Column, width_us: int) -> Column:
    return floor_div(epoch_micros(ts), width_us)


def bin_of(ts: str, bin_width: str = "1 hour") -> Column:
    """The time bin of a clock: stored beside it, tables can be bucketed on (key, bin) for ``interval_join``."""
    return _bin(F.col(ts), interval_us(bin_width))


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_ts: str, right_ts: str, lo: str = "-3 hours", hi: str = "-2 hours",
                  closed: str = "none", bin_width: str = "1 hour", right_bin: str | None = None) -> DataFrame:
    """Pairs with equal keys and ``left_ts + lo <(=) right_ts <(=) left_ts + hi``.

    ``closed`` in {"none", "left", "right", "both"} says which window ends
    are included (the source uses open ends).  The right key column is
    dropped from the output (it equals the left key); other right columns
    must not share names with left columns.  Any ``bin_width`` gives the
    same result; the window width keeps it at two bins per left row.
    ``right_bin`` names a column of ``right`` that holds ``bin_of(right_ts, bin_width)``, so that a table
    bucketed on (key, bin) is read without an exchange; it is dropped from the output.
    """
    if closed not in ("none", "left", "right", "both"):
        raise ValueError("closed must be none|left|right|both")
    width = interval_us(bin_width)
    if width <= 0:
        raise ValueError("bin_width must be positive")
    start, end = shift(left_ts, lo), shift(left_ts, hi)
    lb = left.withColumn("__bin", F.explode(F.sequence(_bin(start, width), _bin(end, width))))
    clash = (set(left.columns) & set(right.columns)) - {right_key} if right_key != left_key else \
        (set(left.columns) & set(right.columns)) - {left_key}
    if clash:
        raise ValueError(f"rename right columns first; shared names: {sorted(clash)}")
    binned = right.withColumn("__rbin", _bin(F.col(right_ts), width)) if right_bin is None else right.withColumnRenamed(right_bin, "__rbin")
    rb = binned.withColumnRenamed(right_key, "__rkey")
    r = F.col(right_ts)
    lower = (r >= start) if closed in ("left", "both") else (r > start)
    upper = (r <= end) if closed in ("right", "both") else (r < end)
    cond = (F.col(left_key) == F.col("__rkey")) & (F.col("__bin") == F.col("__rbin")) & lower & upper
    return lb.join(rb, cond, "inner").drop("__bin", "__rbin", "__rkey")
