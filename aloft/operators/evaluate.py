"""Scoring without collecting predictions.

The source collects every (score, label) pair to the driver for a
single-machine metrics library.  Here everything is an aggregate over the
prediction table:

* hard-prediction metrics come from the 2x2 confusion counts;
* curves need cumulative TP/FP in descending score order.  A window without
  a partition would pull all rows into one task, so the prefix sum is two
  levels: rows are reduced to one row per distinct score (partial
  aggregate, one shuffle that all steps share), the scores are cut into
  ``ranges`` by approximate splitters (one scalar subquery), range totals (at
  most ``ranges`` rows) are cumulated and broadcast, and each range
  runs its own window.  Exact, and no job runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aloft.operators.summarize import lower_bound


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Counts per (label, prediction) (V1)."""
    return df.groupBy(F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def class_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy, macro precision/recall/F1 and balanced accuracy, one row (V2, V3).

    Zero division gives 0.  ``roc_auc_hard`` is the area under the ROC of the
    hard predictions, which equals balanced accuracy (and macro recall).
    """
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    c = df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
               F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"))

    def div(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    prec1, prec0 = div(tp, tp + fp), div(tn, tn + fn)
    rec1, rec0 = div(tp, tp + fn), div(tn, tn + fp)
    f1_1 = div(2 * prec1 * rec1, prec1 + rec1)
    f1_0 = div(2 * prec0 * rec0, prec0 + rec0)
    n = tp + fp + tn + fn
    return c.select(
        "tp", "fp", "tn", "fn",
        div(tp + tn, n).alias("accuracy"),
        ((prec1 + prec0) / 2).alias("precision_macro"),
        ((rec1 + rec0) / 2).alias("recall_macro"),
        ((f1_1 + f1_0) / 2).alias("f1_macro"),
        ((rec1 + rec0) / 2).alias("balanced_accuracy"),
        ((rec1 + rec0) / 2).alias("roc_auc_hard"))


def cumulative_counts(df: DataFrame, label: str, score: str, ranges: int = 1024,
                      accuracy: int = 10_000) -> DataFrame:
    """Per distinct score (descending): tp/fp at that score and cumulative TP/FP
    of all rows scoring >= it, plus totals P and N (W4).  Rows with a null label or score are left out."""
    y = F.col(label).try_cast("int")
    src = df.select(y.alias("__y"), F.col(score).cast("double").alias("score")).where(F.col("score").isNotNull() & F.col("__y").isNotNull())
    per = src.groupBy("score").agg(F.sum("__y").cast("long").alias("tp"), F.sum(1 - F.col("__y")).cast("long").alias("fp"))
    splitters = per.agg(F.percentile_approx("score", [i / ranges for i in range(1, ranges)], accuracy).alias("__sp"))   # one value
    per = per.withColumn("__sp", splitters.scalar()).withColumn("__r", -lower_bound(F.col("__sp"), F.col("score"), ranges - 1)).drop("__sp")
    # at most `ranges` rows: range 0 is the lowest scores
    totals = per.groupBy("__r").agg(F.sum("tp").alias("__tp"), F.sum("fp").alias("__fp"))
    every = Window.partitionBy(F.lit(0))
    upto = every.orderBy("__r")
    totals = totals.select("__r", (F.sum("__tp").over(upto) - F.col("__tp")).alias("__tp0"), (F.sum("__fp").over(upto) - F.col("__fp")).alias("__fp0"),
                           F.sum("__tp").over(every).alias("P"), F.sum("__fp").over(every).alias("N"))
    inside = Window.partitionBy("__r").orderBy(F.col("score").desc())
    return per.join(F.broadcast(totals), "__r").select(
        "score", "tp", "fp", (F.col("__tp0") + F.sum("tp").over(inside)).alias("cum_tp"),
        (F.col("__fp0") + F.sum("fp").over(inside)).alias("cum_fp"), "P", "N")


def _share(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, fpr, tpr) at every distinct score, with the end points (0, 0) and (1, 1) (V5).

    The end points have no score.  The rate of an absent class is 0 (and 1 at the end)."""
    c = cumulative_counts(df, label, score)
    curve = c.select("score", _share(F.col("cum_fp"), F.col("N")).alias("fpr"), _share(F.col("cum_tp"), F.col("P")).alias("tpr"))
    ends = df.sparkSession.range(2).select(F.lit(None).cast("double").alias("score"), F.col("id").cast("double").alias("fpr"),
                                           F.col("id").cast("double").alias("tpr"))
    return curve.unionByName(ends)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by the trapezoid rule, one row (V5); null if a class is absent.

    The previous point of each threshold is (cum - own counts), so no lag
    over the global order is needed.
    """
    c = cumulative_counts(df, label, score)
    area = F.try_divide(F.col("fp").cast("double"), F.col("N")) * F.try_divide((2 * F.col("cum_tp") - F.col("tp")).cast("double"), F.col("P")) / 2
    return c.agg(F.sum(area).alias("roc_auc"))


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, precision, recall) at every distinct score, with the end point precision 1, recall 0 (V6).

    The end point has no score.  Without positives the recall is 0."""
    c = cumulative_counts(df, label, score)
    curve = c.select("score", (F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("precision"),
                     _share(F.col("cum_tp"), F.col("P")).alias("recall"))
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("score"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return curve.unionByName(end)


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """AP = sum over thresholds of (R_n - R_(n-1)) * P_n, the step form (V4); 0 without positives.

    R_n - R_(n-1) is the threshold's own tp / P, so it is one aggregate
    over the cumulative table.
    """
    c = cumulative_counts(df, label, score)
    term = _share(F.col("tp"), F.col("P")) * (F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp")))
    return c.agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("average_precision"))


def compare_models(runs: Mapping[str, DataFrame], label: str, pred: str) -> DataFrame:
    """One metrics row per named prediction table (V7)."""
    out = None
    for name, preds in runs.items():
        m = class_metrics(preds, label, pred).withColumn("model", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out
