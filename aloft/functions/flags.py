"""Binary indicator columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag_equals(col, value) -> Column:
    """1 when ``col == value``, else 0; a null value gives 0."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce((c == F.lit(value)).cast("int"), F.lit(0))
