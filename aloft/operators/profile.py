"""Profiling aggregates (A8-A22).  Each is one (or a few) partial-aggregating jobs; long-form outputs."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from aloft.functions.stats import mean
from aloft.operators.summarize import exact_quantiles, quantiles
from aloft.sources.io import dim_table


def _stack(wide: DataFrame, names: Sequence[str], fields: Sequence[str], name_col: str = "column",
           keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``<name>__<field>`` columns to one row per name."""
    parts = ", ".join(f"'{n}', " + ", ".join(f"`{n}__{f}`" for f in fields) for n in names)
    return wide.selectExpr(*keep, f"stack({len(names)}, {parts}) as ({name_col}, {', '.join(fields)})")


def profile_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null (and NaN, for floating columns) count and share per column (A10)."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for c in cols:
        miss = F.col(c).isNull()
        if isinstance(types[c], (DoubleType, FloatType)):
            miss = miss | F.isnan(c)
        aggs.append(F.count_if(miss).alias(f"{c}__n_missing"))
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    long = _stack(wide, cols, ["n_missing"], keep=["n_rows"])
    return long.withColumn("missing_share", F.try_divide(F.col("n_missing").cast("double"), F.col("n_rows")))


def tail_bounds(df: DataFrame, col: str, lo: float = 0.00001, hi: float = 0.99999) -> DataFrame:
    """Outlier bounds on signed halves: quantile ``lo`` of the negative values
    and quantile ``hi`` of the positive values, exact (A11).  Both halves go through one
    pass, and only the rows of the two tails are shuffled."""
    v = F.col(col)
    signed = df.select(F.when(v < 0, v).alias("neg"), F.when(v > 0, v).alias("pos"))
    q = exact_quantiles(signed, ["neg", "pos"], {"neg": [lo], "pos": [hi]})
    return q.select(F.col("column").alias("side"), "prob", F.col("value").alias("bound"))


def describe_measure(df: DataFrame, cols: Sequence[str], scale: int | None = None) -> DataFrame:
    """Count, mean, sample std, min, max per measure, one job, long form.
    ``scale``: exact means for fixed-point measures."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__n"), mean(c, scale).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__std"), F.min(F.col(c).cast("double")).alias(f"{c}__min"),
                 F.max(F.col(c).cast("double")).alias(f"{c}__max")]
    return _stack(df.agg(*aggs), cols, ["n", "mean", "std", "min", "max"])


def histogram(df: DataFrame, col: str, lo: float, hi: float, n: int) -> DataFrame:
    """Counts per equal-width bucket of [lo, hi); 0 below, n+1 at/above ``hi``."""
    b = F.width_bucket(F.col(col), F.lit(float(lo)), F.lit(float(hi)), F.lit(n))
    return df.where(F.col(col).isNotNull()).groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def mean_by(df: DataFrame, keys: Sequence[str], col: str, out: str = "mean", scale: int | None = None) -> DataFrame:
    """Mean of a measure by group, with the group size."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), mean(col, scale).alias(out))


def rate_by(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Events, flagged events and their share per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                 F.sum(F.col(flag).cast("long")).alias("n_flagged"),
                                 F.avg(F.col(flag).cast("double")).alias("rate"))


def conditional_rate(df: DataFrame, given: str, flag: str) -> DataFrame:
    """P(flag | given) for every value of ``given``."""
    return rate_by(df, [given], flag)


def box_summary(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Min, quartiles, median, max of each measure per class, exact.
    All measures go through one pass."""
    q = quantiles(df, list(cols), [0.0, 0.25, 0.5, 0.75, 1.0], by=by)
    return q.select(*by, F.col("column").alias("measure"), "prob", "value")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair (a <= b by position), long form.

    One Gram matrix on vectors in place of an aggregate per pair: a row becomes (1 where a value is there, the value less its
    column's mean, its square), so the products of these hold the counts, sums and squares of all pairs at once, pairwise
    over the rows that have both values.  The tasks add up the matrix, (3 x columns)^2 numbers that never grow with the
    rows.  Null and NaN are missing; a pair without variance gives null."""
    names, spark = list(cols), df.sparkSession
    v = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in names]
    means = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(v)]).first()
    there = [F.when(x.isNotNull(), 1.0).otherwise(0.0) for x in v]
    moved = [F.coalesce(x - F.lit(m), F.lit(0.0)) if m is not None else F.lit(0.0) for x, m in zip(v, means, strict=True)]
    rows = df.select(array_to_vector(F.array(*there, *moved, *[x * x for x in moved])).alias("v"))
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v")).computeGramianMatrix().toArray()
    d = len(names)
    n, sums, squares, cross = gram[:d, :d], gram[:d, d: 2 * d], gram[:d, 2 * d:], gram[d: 2 * d, d: 2 * d]
    out = []
    for i in range(d):
        for j in range(i, d):
            x, y, m = sums[j, i], sums[i, j], n[i, j]         # sums over the rows that have both
            var = [m * squares[j, i] - x * x, m * squares[i, j] - y * y]
            # what rounding leaves of a constant column is no variance
            flat = any(t <= 1e-24 * m * m * (means[k] or 0.0) ** 2 or t <= 0 for t, k in zip(var, (i, j), strict=True))
            corr = None if m < 2 or flat else float((m * cross[i, j] - x * y) / math.sqrt(var[0] * var[1]))
            out.append((names[i], names[j], corr))
    return dim_table(spark, out, "col_a string, col_b string, corr double")


def share_by(df: DataFrame, by: str, cat: str) -> DataFrame:
    """Share of each category within each class (A19).  The total per class
    comes from a window over the already-aggregated (class, category) table."""
    c = df.groupBy(by, cat).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(by)))


def audit_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, duplicated keys and rows in them.

    One shuffle on the key (count per key, partial-aggregated), then a
    global aggregate of the per-key counts.
    """
    per = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    return per.agg(F.sum("__n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
                   F.count_if(F.col("__n") > 1).alias("n_dup_keys"),
                   F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).alias("n_rows_in_dups"))


def gini_by_feature(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Weighted Gini impurity of the split on each categorical feature.

    Unpivot (feature, value) with ``stack``, count per (feature, value,
    label) with a partial aggregate, then per value G = 1 - sum p_i^2 and
    per feature sum (n_value / n) * G.  Output: feature, gini.
    """
    parts = ", ".join(f"'{f}', cast(`{f}` as string)" for f in features)
    long = df.selectExpr(f"`{label}` as __y", f"stack({len(features)}, {parts}) as (feature, value)")
    c = long.groupBy("feature", "value", "__y").agg(F.count(F.lit(1)).alias("n"))
    per_value = c.groupBy("feature", "value").agg(
        F.sum("n").alias("nv"), F.sum(F.col("n") * F.col("n")).alias("sq"))
    per_value = per_value.withColumn("g", F.lit(1.0) - F.col("sq") / (F.col("nv") * F.col("nv")))
    return per_value.groupBy("feature").agg(
        (F.sum(F.col("nv") * F.col("g")) / F.sum("nv")).alias("gini"))


def exclusion_ledger(df: DataFrame, steps: Mapping[str, Column | str], flag: str) -> DataFrame:
    """Rows and flag rate after each cumulative filter step, one job.

    ``steps`` is ordered {name: keep-condition}; row i reports the rows
    passing steps 1..i (step 0 = input).
    """
    conds = [F.expr(c) if isinstance(c, str) else c for c in steps.values()]
    names = ["input"] + list(steps)
    aggs, acc = [], F.lit(True)
    for i, name in enumerate(names):
        if i > 0:
            acc = acc & F.coalesce(conds[i - 1], F.lit(False))
        aggs += [F.count_if(acc).alias(f"s{i}__n"),
                 F.sum(F.when(acc, F.col(flag).cast("double"))).alias(f"s{i}__flagged")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"{i}, '{n}', `s{i}__n`, `s{i}__flagged`" for i, n in enumerate(names))
    out = wide.selectExpr(f"stack({len(names)}, {parts}) as (step, name, n_rows, n_flagged)")
    return out.withColumn("flag_rate", F.try_divide(F.col("n_flagged"), F.col("n_rows")))
