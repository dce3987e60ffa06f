"""Previous event of the same entity (J1, W1) without a rank self-join.

The source ranks each entity's events newest-first with ``dense_rank`` and
self-joins on ``rank + 1``.  Here the predecessor comes from a window
ordered by the event clocks, with two scale measures:

* **Split entities.**  A window partitioned by the entity alone sends a
  whole entity to one task; one entity may hold a third of all rows.  The
  window is therefore always partitioned by ``(entity, segment)``, where
  ``segment`` is a fixed, order-monotone bucket of the first clock (the hour
  by default).  The first event of each segment takes its predecessor from
  the previous segment's last event, found on a per-segment table (one row
  per entity and segment, pre-aggregated map-side) and joined back on the
  same ``(entity, segment)`` key the window is already partitioned by.
  Nothing is counted beforehand, and no job runs while the plan is built.
  Clocks that are neither dates nor timestamps (numbers, strings, ...) have no hour: their segments are the ranges
  between splitters over (entity, clocks), taken from a bounded sample of the rows (``_with_range_segment``).
* **Ties.**  ``ties="one"`` gives every event exactly one predecessor: the
  event just before it in (clocks, tie-break) order.  ``ties="all"``
  reproduces the dense-rank semantics: an event is paired with *every*
  event of the previous distinct clock tuple, so events tied on all clocks
  fan out (the source's behaviour).  The previous tuple is found on the table
  of distinct tuples; the pairing is an equi-join on ``(entity, clock
  tuple)``, never a join within a whole entity.

Events without an entity are put aside before any window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from aloft.functions.clock import floor_to
from aloft.operators.summarize import lower_bound


def _segment_expr(df: DataFrame, first_order: str, split: str | Column | None) -> Column | None:
    if split is None:
        return F.lit(0)
    if isinstance(split, Column):
        return split
    dtype = df.schema[first_order].dataType
    if isinstance(dtype, TimestampNTZType):
        return floor_to(F.col(first_order), split)
    if isinstance(dtype, TimestampType):
        return F.date_trunc(split, F.col(first_order))
    if isinstance(dtype, DateType):
        return F.col(first_order)
    return None


def _with_range_segment(base: DataFrame, entity: str, order_cols: Sequence[str], splitters: int = 1024) -> DataFrame:
    """``base`` with ``__seg``: the range of a row's (entity, clocks) between at most ``splitters`` sampled tuples: within an entity it never falls as
    the clocks rise, and a hot entity with many clocks spreads over many ranges.

    The sample is the tuple of least hash in each of ``splitters`` hash buckets (partially aggregated, one row that
    a scalar subquery hands to all tasks), so it is bounded and the same for any layout of the rows."""
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate([entity, *order_cols])])
    h = F.xxhash64(key)
    least = base.select(F.pmod(h, F.lit(splitters)).alias("b"), F.struct(F.xxhash64(F.lit(1), key).alias("h"), key.alias("k")).alias("s")) \
        .groupBy("b").agg(F.min("s").alias("s"))
    ranges = least.agg(F.sort_array(F.collect_list("s.k"))).scalar()
    return base.withColumn("__sp", ranges).withColumn("__seg", lower_bound(F.col("__sp"), key, splitters)).drop("__sp")


def with_previous(df: DataFrame, entity: str, order_cols: Sequence[str], carry: Sequence[str],
                  prefix: str = "PREV_", ties: str = "one", keep_first: bool = False,
                  tie_break: Sequence[str] | None = None, split: str | Column | None = "hour") -> DataFrame:
    """Attach columns of the previous event of the same entity.

    ``order_cols`` are the clocks, oldest first (ascending).  ``carry``
    columns of the predecessor are added as ``prefix + name``.  Events with
    a null entity never get a predecessor.  ``keep_first=False`` drops
    events without a predecessor (inner-join semantics of the source);
    ``True`` keeps them with nulls.  ``tie_break`` orders events that tie
    on all clocks (``ties="one"`` only; required there for determinism).
    ``split`` is the segment: a unit of the first clock (``"hour"``,
    ``"minute"``, ``"day"``; a date clock is its own segment, clocks of other types are split by
    sampled ranges), an order-monotone Column, or None for one window per entity.
    """
    if ties not in ("one", "all"):
        raise ValueError("ties must be 'one' or 'all'")
    order_cols, carry = list(order_cols), list(carry)
    base = df.where(F.col(entity).isNotNull())
    segment = _segment_expr(df, order_cols[0], split)
    base = _with_range_segment(base, entity, order_cols) if segment is None else base.withColumn("__seg", segment)
    keys = [entity, "__seg"]
    by_segment = Window.partitionBy(entity).orderBy("__seg")          # one row per (entity, segment)

    if ties == "one":
        order_all = order_cols + list(tie_break or [])
        payload = F.struct(*[F.col(c).alias(c) for c in carry])
        w = Window.partitionBy(*keys).orderBy(*order_all)
        lagged = base.withColumn("__prev", F.lag(payload).over(w)).withColumn("__first", F.row_number().over(w) == 1)
        # aggregated on the window's output, which is partitioned by (entity, segment) already: no shuffle
        last = lagged.groupBy(*keys).agg(F.max_by(payload, F.struct(*order_all)).alias("__last"))
        carry_in = last.select(*keys, F.lag("__last").over(by_segment).alias("__before"))
        lagged = lagged.join(carry_in, keys, "left") \
            .withColumn("__prev", F.when(F.col("__first"), F.col("__before")).otherwise(F.col("__prev")))
        out = lagged.withColumns({prefix + c: F.col("__prev").getField(c) for c in carry})
        out = out if keep_first else out.where(F.col("__prev").isNotNull())
        out = out.drop("__prev", "__first", "__seg", "__before")
    else:
        tup = F.struct(*[F.col(c) for c in order_cols])
        base = base.withColumn("__t", tup)
        tuples = base.select(*keys, "__t").distinct()
        last = tuples.groupBy(*keys).agg(F.max("__t").alias("__last"))
        carry_in = last.select(*keys, F.lag("__last").over(by_segment).alias("__before"))
        before = F.coalesce(F.lag("__t").over(Window.partitionBy(*keys).orderBy("__t")), F.col("__before"))
        steps = tuples.join(carry_in, keys, "left").withColumn("__prev_t", before).select(*keys, "__t", "__prev_t")
        prev = df.where(F.col(entity).isNotNull()).select(
            F.col(entity).alias("__pe"), tup.alias("__pt"), *[F.col(c).alias(prefix + c) for c in carry])
        cond = (F.col(entity) == F.col("__pe")) & (F.col("__prev_t") == F.col("__pt"))
        out = base.join(steps, [*keys, "__t"]).join(prev, cond, "left" if keep_first else "inner") \
            .select(*df.columns, *[prefix + c for c in carry])
    if not keep_first:
        return out
    types = {f.name: f.dataType for f in df.schema.fields}
    aside = df.where(F.col(entity).isNull()).withColumns({prefix + c: F.lit(None).cast(types[c]) for c in carry})
    return out.select(*aside.columns).unionByName(aside)
