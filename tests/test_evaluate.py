import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aloft.operators import evaluate


@pytest.fixture
def curve_toy(spark):
    return spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.7, 0), (0.2, 0)], "score double, y int")


def test_cumulative_counts_toy(curve_toy):
    got = sorted(((r.score, r.cum_tp, r.cum_fp) for r in evaluate.cumulative_counts(curve_toy, "y", "score", ranges=2).collect()),
                 reverse=True)
    # cumulative TP 1,1,2,2 at 1, 2, 4, 5 rows
    assert got == [(0.9, 1, 0), (0.8, 1, 1), (0.7, 2, 2), (0.2, 2, 3)]


def test_average_precision_toy(curve_toy):
    assert evaluate.average_precision(curve_toy, "y", "score").first()[0] == pytest.approx(0.75)


def test_roc_auc_brute_force(spark):
    rnd = random.Random(3)
    data = [(round(rnd.random(), 2), int(rnd.random() < 0.3)) for _ in range(2000)]
    df = spark.createDataFrame(data, "score double, y int")
    pos = [s for s, y in data if y == 1]
    neg = [s for s, y in data if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc(df, "y", "score").first()[0] == pytest.approx(brute, abs=1e-9)


@pytest.mark.parametrize("ranges", [1, 2, 16, 1024])
def test_two_level_equals_global_window(spark, ranges):
    rnd = random.Random(4)
    df = spark.createDataFrame([(rnd.random(), int(rnd.random() < 0.5)) for _ in range(3000)], "score double, y int")
    ours = evaluate.cumulative_counts(df, "y", "score", ranges=ranges).select("score", "cum_tp", "cum_fp")
    per = df.groupBy("score").agg(F.sum("y").alias("tp"), F.sum(1 - F.col("y")).alias("fp"))
    w = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    ref = per.select("score", F.sum("tp").over(w).alias("cum_tp"), F.sum("fp").over(w).alias("cum_fp"))
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_confusion_toy(spark):
    perfect = spark.createDataFrame([(1, 1), (0, 0), (1, 1)], "y int, p int")
    m = evaluate.class_metrics(perfect, "y", "p").first()
    assert (m.accuracy, m.f1_macro, m.roc_auc_hard) == (1.0, 1.0, 1.0)
    one_class = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "y int, p int")
    m = evaluate.class_metrics(one_class, "y", "p").first()   # zero division -> 0
    assert m.precision_macro == pytest.approx((0 + 2 / 3) / 2)
    assert m.recall_macro == pytest.approx(0.5) and m.balanced_accuracy == pytest.approx(0.5)
    empty = spark.createDataFrame([], "y int, p int")
    m = evaluate.class_metrics(empty, "y", "p").first()
    assert (m.tp, m.accuracy, m.f1_macro) == (0, 0.0, 0.0)
    assert sorted(tuple(r) for r in evaluate.confusion(one_class, "y", "p").collect()) == [(0, 0, 2), (1, 0, 1)]


def test_curves_without_a_class_or_rows(spark):
    def of(rows):
        df = spark.createDataFrame(rows, "score double, y int")
        return (evaluate.average_precision(df, "y", "score").first()[0], evaluate.roc_auc(df, "y", "score").first()[0],
                sorted((r.fpr, r.tpr) for r in evaluate.roc_curve(df, "y", "score").collect()),
                sorted((r.precision, r.recall) for r in evaluate.pr_curve(df, "y", "score").collect()))

    assert of([]) == (0.0, None, [(0.0, 0.0), (1.0, 1.0)], [(1.0, 0.0)])
    assert of([(0.3, 0), (0.7, 0)]) == (0.0, None, [(0.0, 0.0), (0.5, 0.0), (1.0, 0.0), (1.0, 1.0)], [(0.0, 0.0), (0.0, 0.0), (1.0, 0.0)])
    assert of([(0.3, 1), (None, 1), (0.2, None)]) == (1.0, None, [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)], [(1.0, 0.0), (1.0, 1.0)])
