"""Per-group summaries, modes, exact quantiles and grouped imputation."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aloft.functions.stats import mean
from aloft.sources.io import dim_table, stage


def summarize(df: DataFrame, key: str | Sequence[str], means: Sequence[str] = (),
              modes: Sequence[str] = (), scale: int | None = None) -> DataFrame:
    """Mean of each numeric measure and mode of each category per key, in ONE aggregate.

    The source runs a mean aggregate and two count + ``row_number`` mode
    jobs and joins three tables back; here it is a single hash aggregate.
    Modes ignore nulls and break ties by the lowest value.  Meant for keys
    whose groups are bounded by design (readings matched to one event):
    the mode buffer holds the distinct values of one group.  For a table
    with hot keys use ``mode_by``.  ``scale``: exact means for fixed-point
    measures (``functions.stats.mean``).
    """
    keys = [key] if isinstance(key, str) else list(key)
    aggs = [mean(c, scale).alias(c) for c in means]
    aggs += [F.mode(c, deterministic=True).alias(c) for c in modes]
    return df.groupBy(*keys).agg(*aggs)


def mode_by(df: DataFrame, key: str | Sequence[str], col: str, out: str | None = None) -> DataFrame:
    """Most frequent non-null value of ``col`` per key, ties to the lowest value (A5).

    Two partial-aggregating steps (count per (key, value), then pick per
    key by ``max_by``), so memory never holds a group's values and a hot
    key is pre-combined map-side.
    """
    keys = [key] if isinstance(key, str) else list(key)
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("__n"))
    # smallest (-count, value): the largest count, then the lowest value (any orderable type)
    pick = F.min_by(F.col(col), F.struct(-F.col("__n"), F.col(col)))
    return counts.groupBy(*keys).agg(pick.alias(out or col))


def _group(by: Sequence[str]) -> Column:
    """The group of a row as one struct: null keys are a group like any other, in joins too."""
    return F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))


def group_percentile(df: DataFrame, keys: Sequence[str], cols: Sequence[str], prob: float = 0.5,
                     suffix: str = "_md", weight: str | None = None) -> DataFrame:
    """Exact interpolated percentile of several columns per group, all columns in one pass.

    Nulls and NaN are missing values and ignored; a group without a value gives
    null.  A null key is a group of its own.  ``weight``: as in ``exact_quantiles``.
    """
    keys = list(keys)
    q = exact_quantiles(df, cols, [prob], by=keys, weight=weight)
    wide = q.groupBy("__g").agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c + suffix) for c in cols])
    return df.select(_group(keys).alias("__g")).distinct().join(wide, "__g", "left") \
        .select(*[F.col("__g").getField(k).alias(k) for k in keys], *[c + suffix for c in cols])


def lower_bound(sorted_arr: Column, v: Column, length: int) -> Column:
    """Number of elements of an ascending array that are < ``v``, by binary search.

    ``length`` bounds the array size (it fixes the number of halving steps).
    O(log n) per row through a higher-order ``aggregate``.
    """
    steps = max(1, math.ceil(math.log2(length + 1)))
    init = F.struct(F.lit(0).alias("lo"), F.size(sorted_arr).alias("hi"))

    def step(acc, _):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        right = F.struct((mid + 1).alias("lo"), hi.alias("hi"))
        left = F.struct(lo.alias("lo"), mid.alias("hi"))
        return F.when(lo < hi, F.when(F.get(sorted_arr, mid) < v, right).otherwise(left)).otherwise(acc)

    # never null: else joins on the result would test it for null on every row below the aggregates
    return F.coalesce(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step, lambda acc: acc["lo"]), F.lit(0))


def quantiles(df: DataFrame, cols: str | Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated quantiles per group: ``by`` columns, ``column`` (for a list of columns), ``prob``, ``value``."""
    by, one = list(by), isinstance(cols, str)
    q = exact_quantiles(df, [cols] if one else list(cols), probs, by)
    return q.select(*[F.col("__g").getField(k).alias(k) for k in by], *([] if one else ["column"]), "prob", "value")


# Error of a rank, as a share of the rows, that a sketch of parameter k exceeds once in a hundred times (the sketch's published rule).
def rank_error(k: int) -> float:
    return 2.296 / k**0.9021


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] | Mapping[str, Sequence[float]], by: Sequence[str] = (),
                    sketch_k: int = 8192, margin: float = 1.5, weight: str | None = None) -> DataFrame:
    """Exact interpolated quantiles of several columns per group: (__g, column, prob, value); ``probs`` for all or per column.

    Equal to ``percentile(col, p)`` over the values that are neither null nor
    NaN (linear interpolation between the order statistics at floor and ceil
    of (n-1)p).  One path for groups of every size; no task holds a group:

    1. one scan makes a mergeable sketch (KLL) and a count per group and column, kept in a written table: it
       brackets each wanted rank by two values, about ``2 * margin * rank_error(sketch_k)`` of the group apart
       (a group of up to ``sketch_k`` values is its own bracket);
    2. a second scan counts the values below a bracket (partially aggregated to one row per task) and keeps the
       bracket's own values with their counts, the only rows that are shuffled; their running sum gives the ranks.

    The counts are exact, so they show whether a bracket held its rank; where one did not, step 2 is run again for that
    group with four times the margin, until the bracket is the whole group.  The result does not depend on the sketches.

    ``weight`` names a whole number: a row stands for so many equal rows (none: zero, negative or null).  Only groups of
    more than ``sketch_k`` rows get a sketch, made of the repeated values, as it takes no weights; in step 2 weights are added up.
    """
    probs = {c: list(probs[c] if isinstance(probs, Mapping) else probs) for c in cols}
    names = list(cols)
    spark = df.sparkSession
    values = [F.nanvl(F.col(c).cast("double") + 0.0, F.lit(None).cast("double")).alias(f"__v{i}") for i, c in enumerate(names)]
    sketch = [F.kll_sketch_agg_double(f"__v{i}", F.lit(sketch_k)).alias(f"__s{i}") for i in range(len(names))]
    if weight is None:
        src = df.select(_group(by).alias("__g"), *values)
        sketches = stage(src.groupBy("__g").agg(*[F.count(f"__v{i}").alias(f"__n{i}") for i in range(len(names))], *sketch))
    else:
        src = df.where(F.col(weight) > 0).select(_group(by).alias("__g"), *values, F.col(weight).cast("long").alias("__w"))
        counts = [F.coalesce(F.sum(F.when(F.col(f"__v{i}").isNotNull(), F.col("__w"))), F.lit(0)).alias(f"__n{i}") for i in range(len(names))]
        sizes = stage(src.groupBy("__g").agg(F.count(F.lit(1)).alias("__m"), *counts))
        large = src.join(sizes.where(F.col("__m") > sketch_k).select("__g"), "__g", "left_semi")
        sketches = stage(sizes.drop("__m").join(_repeated(large, "__w").groupBy("__g").agg(*sketch), "__g", "left"))
    parts, width = [], margin * rank_error(sketch_k) + 1 / sketch_k
    rest = sketches
    while True:
        located = _between(src, _brackets(rest, [probs[c] for c in names], width, sketch_k), [probs[c] for c in names])
        found = stage(located)
        lost = found.where(F.col("lo").isNull() | F.col("hi").isNull()).select("__g").distinct()
        # counted on the written table: an Observation would leave the session unable to ship fitted models (Spark 4.1)
        if lost.isEmpty():
            parts.append(found)
            break
        parts.append(found.join(lost, "__g", "left_anti"))
        rest = sketches.join(lost, "__g", "left_semi")
        width *= 4
    res = reduce(DataFrame.unionByName, parts)
    at = (F.col("n") - 1) * F.col("prob")
    value = F.when(F.floor(at) == F.ceil(at), F.col("lo")).otherwise((F.ceil(at) - at) * F.col("lo") + (at - F.floor(at)) * F.col("hi"))
    name = dim_table(spark, list(enumerate(names)), "i int, column string")
    return res.join(F.broadcast(name), "i").select("__g", "column", "prob", value.alias("value"))


def _repeated(df: DataFrame, weight: str, run: int = 4096) -> DataFrame:
    """Each row ``weight`` times, in runs of at most ``run`` (no array grows with a weight's value beyond weight / run)."""
    runs = df.withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(weight) - 1) / run).cast("long"))))
    last = F.least(F.lit(run).cast("long"), F.col(weight) - F.col("__run") * run)
    return runs.withColumn("__run", F.explode(F.sequence(F.lit(1).cast("long"), last))).drop("__run")


def _brackets(sketches: DataFrame, probs: Sequence[Sequence[float]], width: float, small: int) -> DataFrame:
    """Per group, for each column an array ``__b<i>`` of (prob, n, lo, hi): lo <= the wanted order statistics <= hi, most likely."""
    out = []
    for i, ps in enumerate(probs):
        wide = (F.col(f"__n{i}") > small) & F.lit(width < 1)
        ends = [[min(1.0, max(0.0, p + sign * width)) for p in ps] for sign in (-1, 1)]
        q = [F.when(wide, F.kll_sketch_get_quantile_double(F.col(f"__s{i}"), F.array(*[F.lit(float(x)) for x in e]))) for e in ends]
        slots = [F.struct(F.lit(float(p)).alias("prob"), F.col(f"__n{i}").alias("n"), F.get(q[0], F.lit(j)).alias("lo"), F.get(q[1], F.lit(j)).alias("hi"))
                 for j, p in enumerate(ps)]
        out.append(F.when(F.col(f"__n{i}") > 0, F.array(*slots)).alias(f"__b{i}"))
    return sketches.select("__g", *out)


def _between(src: DataFrame, brackets: DataFrame, probs: Sequence[Sequence[float]]) -> DataFrame:
    """(__g, i, prob, n, lo, hi): the order statistics at floor and ceil of (n-1)*prob, null where the bracket did not hold them."""
    def kept(i: int) -> Column:
        v = F.col(f"__v{i}")
        inside = F.filter(F.col(f"__b{i}"), lambda b: v.isNotNull() & (b["hi"].isNull() | (v <= b["hi"])))
        rows = F.transform(inside, lambda b: F.struct(F.lit(i).alias("i"), b["prob"].alias("prob"), b["n"].alias("n"),
                                                      F.when(b["lo"].isNull() | (v >= b["lo"]), v).alias("v")))       # null: below the bracket
        return F.coalesce(rows, F.array().cast("array<struct<i:int,prob:double,n:bigint,v:double>>"))

    weight = [c for c in src.columns if c == "__w"]
    rows = src.join(brackets, "__g").select("__g", *weight, F.explode(F.concat(*[kept(i) for i in range(len(probs))])).alias("x"))
    counted = rows.groupBy("__g", "x.i", "x.prob", "x.n", "x.v").agg((F.sum("__w") if weight else F.count(F.lit(1))).alias("c"))
    slot = ["__g", "i", "prob", "n"]
    upto = counted.withColumn("upto", F.sum("c").over(Window.partitionBy(*slot).orderBy(F.col("v").asc_nulls_first())))
    at = (F.col("n") - 1) * F.col("prob")
    hit = lambda k: F.max(F.when((k.cast("long") < F.col("upto")) & (k.cast("long") >= F.col("upto") - F.col("c")), F.col("v")))
    return upto.groupBy(*slot).agg(hit(F.floor(at)).alias("lo"), hit(F.ceil(at)).alias("hi"))


def impute_by_group(df: DataFrame, keys: Sequence[str], cols: Sequence[str], prob: float = 0.5,
                    suffix: str = "_imp", stat_suffix: str = "_md", keep_stats: bool = False,
                    counted: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """``coalesce(value, percentile of its group)`` for each column.

    The group statistic is computed once per group and left-joined back on
    the group (null keys included), so row count is unchanged.  Nulls and NaN are
    missing and get imputed; groups without a value give null (the source's
    NaN), which a later ``drop_null`` removes.

    ``counted`` is ``df`` with equal rows of (keys, cols) put together and their number in ``weight``, where the caller
    has such a table: the statistics are then made of it, without a pass over the rows.
    """
    stats = group_percentile(df if counted is None else counted, keys, cols, prob, stat_suffix, weight)
    # written (its parts are, already): the planner knows its size and does not shuffle the rows for a small one
    stats = stage(stats.select(_group(list(keys)).alias("__g"), *[c + stat_suffix for c in cols]))
    out = df.withColumn("__g", _group(list(keys))).join(stats, on="__g", how="left").drop("__g")
    present = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    out = out.withColumns({c + suffix: F.coalesce(present(c), F.col(c + stat_suffix)) for c in cols})
    return out if keep_stats else out.drop(*[c + stat_suffix for c in cols])


def attach(df: DataFrame, summary: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left-join a per-key summary back onto the event table."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(summary, on=keys, how="left")


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct rows of a projection."""
    return df.select(*cols).distinct()
