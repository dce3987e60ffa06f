"""Row keys, sentinels, null handling and range trims."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aloft.sources.io import stage


def with_row_key(df: DataFrame, name: str = "ROW_KEY", cols: Sequence[str] | None = None,
                 unique: bool = False) -> DataFrame:
    """Add a row key.

    With ``cols`` the key is the 128-bit md5 (hex) of those business columns, each
    written with its length and with a mark of its own for null: stable across
    file layouts and reruns, and different for (a, null, b) and (a, b, null).
    ``unique`` appends ``-2``, ``-3``, ... to the key of repeated rows, whose columns
    are all equal, so no two rows share a key.  The rows are written once with a number of
    their own (part and place); repeats are numbered part by part, behind the counts of the parts before, so a row that
    is a third of the table is no task of its own.  Without ``cols`` the layout-dependent
    ``monotonically_increasing_id`` surrogate is used.
    """
    if not cols:
        return df.withColumn(name, F.monotonically_increasing_id())
    value = [F.col(c).cast("string") for c in cols]
    key = F.md5(F.concat(*[F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in value]))
    if not unique:
        return df.withColumn(name, key)
    kept = stage(df.withColumn("__key", key).withColumn("__at", F.monotonically_increasing_id()))
    kept = kept.withColumn("__part", F.shiftright("__at", 33))
    counts = kept.groupBy("__key", "__part").agg(F.count(F.lit(1)).alias("__n"))           # a row per key and part at most
    before = F.sum("__n").over(Window.partitionBy("__key").orderBy("__part")) - F.col("__n")
    counts = counts.withColumn("__before", before).select("__key", "__part", "__before")
    inside = F.row_number().over(Window.partitionBy("__key", "__part").orderBy("__at"))
    nth = F.col("__before") + F.col("__nth")
    return kept.withColumn("__nth", inside).join(counts, ["__key", "__part"]) \
        .withColumn(name, F.when(nth > 1, F.concat("__key", F.lit("-"), nth.cast("string"))).otherwise(F.col("__key"))) \
        .select(*[c for c in df.columns if c != name], name)


def null_if(df: DataFrame, sentinels: Mapping[str, object]) -> DataFrame:
    """Replace a sentinel by null, per column, in one projection."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(v)) for c, v in sentinels.items()})


def fill_null(df: DataFrame, value, cols: Sequence[str]) -> DataFrame:
    """Fill nulls of a column subset (P10)."""
    return df.na.fill(value, subset=list(cols))


def drop_null(df: DataFrame, cols: Sequence[str], how: str = "any") -> DataFrame:
    """Drop rows with a null (or NaN) in any/all of ``cols``."""
    return df.na.drop(how=how, subset=list(cols))


def open_range(col: str, lo=None, hi=None) -> Column:
    """``lo < col < hi``; a missing bound is not checked."""
    c = F.col(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c > F.lit(lo))
    if hi is not None:
        cond = cond & (c < F.lit(hi))
    return cond


def between_open(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    """AND of open-range filters, e.g. ``{"DEP_DELAY": (-45, 1609)}``.

    Plain comparisons, so Catalyst pushes them into the Parquet scan.
    """
    cond = F.lit(True)
    for col, (lo, hi) in bounds.items():
        cond = cond & open_range(col, lo, hi)
    return df.where(cond)


def completed_events(df: DataFrame, predicate: str) -> DataFrame:
    """Filter by a SQL predicate string, e.g. ``"CANCELLED == 0 AND DEP_TIME IS NOT NULL"``."""
    return df.where(F.expr(predicate))
