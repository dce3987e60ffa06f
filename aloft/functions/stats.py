"""Aggregate expressions with order-independent results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean(col, scale: int | None = None) -> Column:
    """Mean of a measure.

    ``scale=None`` is Spark's ``avg`` (a double sum: its last bits depend on
    the order rows are added, i.e. on partitioning).  For fixed-point
    measures (values with ``scale`` decimals) the sum is exact in DECIMAL,
    so the result is the same for any partitioning, rerun or engine:
    double(exact sum) / count.
    """
    c = F.col(col) if isinstance(col, str) else col
    if scale is None:
        return F.avg(c)
    return F.try_divide(F.sum(c.cast(f"decimal(38,{scale})")).cast("double"), F.count(c))


def round_half_up(col, decimals: int = 6) -> Column:
    """floor(x * 10^d + 0.5) / 10^d: the same IEEE operations in any SQL engine."""
    c = F.col(col) if isinstance(col, str) else col
    k = float(10 ** decimals)
    return F.floor(c * F.lit(k) + F.lit(0.5)) / F.lit(k)
