"""Dimension lookups and time-zone attachment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.functions.clock import to_utc


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join a dimension table (J4 inner: unmatched dropped; J5 left: kept).

    How is the planner's choice, by the sizes it knows when the query runs
    (adaptive execution turns a join with a small side into a broadcast).
    """
    return df.join(dim, on=[on] if isinstance(on, str) else list(on), how=how)


def _one_zone(zones: DataFrame, key: str, tz: str) -> DataFrame:
    """One zone per key (the first in order), so that a repeated key multiplies no rows."""
    named = zones.toDF(key, tz)
    return named.groupBy(key).agg(F.min(tz).alias(tz))


def attach_timezone(df: DataFrame, state_col: str, city_col: str, state_tz: DataFrame,
                    city_tz: DataFrame | None = None, out: str = "TIMEZONE") -> DataFrame:
    """Zone per row: city override first, else the zone of the state (X11).

    ``state_tz`` has two columns (state, zone), ``city_tz`` (city, zone);
    they are joined with left lookups (J5) and coalesced (P14).
    """
    res = df.join(_one_zone(state_tz, "__st_key", "__st_tz"), F.col(state_col) == F.col("__st_key"), "left")
    if city_tz is not None:
        res = res.join(_one_zone(city_tz, "__ct_key", "__ct_tz"), F.col(city_col) == F.col("__ct_key"), "left")
        res = res.withColumn(out, F.coalesce("__ct_tz", "__st_tz")).drop("__ct_key", "__ct_tz")
    else:
        res = res.withColumn(out, F.col("__st_tz"))
    return res.drop("__st_key", "__st_tz")


def with_utc(df: DataFrame, ts: str, tz: str, out: str) -> DataFrame:
    """Add the UTC wall clock of local ``ts`` in zone column ``tz``."""
    return df.withColumn(out, to_utc(ts, tz))
