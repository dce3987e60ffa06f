"""The study's models on its own feature table: importance, selection, learning curve, tuning, curves."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.operators import evaluate, features, models
from aloft.sources.io import stage

KEY, SEED = "FLIGHT_IDX", 7
# The columns of the study's basic model.
CATEGORIES = ["MONTH", "DAY_OF_WEEK", "DEP_TIME_BLK"]
NUMBERS = ["PREV_DEP_DELAY", "PREV_DEP_DEL15", "PREP_TIME", "HOURLY_DELAY_RATE", "HOURLY_NUM_OF_FLIGHTS", "PREV_CRS_ELAPSED_TIME",
           "Temperature_imp", "WindSpeed_imp", "CloudMode_binary", "VerticalVisibility_imp", "DewPointTemp_imp"]
# of the study's feature table
COLUMNS = (KEY, "DEP_DEL15", *CATEGORIES, *NUMBERS)
FRACTIONS = (1.0, 0.5, 0.25)
CUTOFF = 1.0


def model_rows(table: DataFrame) -> DataFrame:
    """What the models use of the study's feature table, written once."""
    return stage(table.select(KEY, F.col("DEP_DEL15").cast("double").alias("label"), *CATEGORIES, *NUMBERS))


def train_and_test(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Feature vectors of both sides in written tables; the chain is fitted and the classes are weighed on the train side."""
    train, test = features.split(model_rows(table), KEY, 80, seed=SEED)
    fm, train = features.build_features(features.class_weights(train, "label"), NUMBERS, CATEGORIES)
    keep = [KEY, "label", "features"]
    return stage(train.select(*keep, "classWeights")), stage(fm.transform(test).select(*keep))


def importance(spark: SparkSession, table: DataFrame) -> DataFrame:
    """(name, idx, score, score_of_nodes): the forest's importance of every slot, and the same from its node table."""
    train, _ = train_and_test(table)
    model = models.forest(seed=SEED).fit(train)
    told = features.feature_importance(spark, model, train)
    nodes = models.importance_from_nodes(models.forest_nodes(spark, model)).withColumnRenamed("score", "score_of_nodes")
    return told.join(nodes, "idx", "left").select("name", "idx", "score", F.coalesce("score_of_nodes", F.lit(0.0)).alias("score_of_nodes"))


def selected(spark: SparkSession, table: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Metrics of train and test of a second forest on the slots that score at least ``cutoff``, with their names."""
    train, test = train_and_test(table)
    slots = features.select_features(features.feature_importance(spark, models.forest(seed=SEED).fit(train), train), cutoff)
    at = [i for i, _ in slots]
    train, test = features.keep_slots(train, at), features.keep_slots(test, at)
    metrics = models.train_and_test_metrics(models.forest(seed=SEED).fit(train), train, test)
    return metrics.withColumns({"n_slots": F.lit(len(slots)), "slots": F.lit(", ".join(name for _, name in slots))})


def learning_curve(table: DataFrame) -> DataFrame:
    """Metrics per fraction and side of the study's forest (60 trees, depth 8, 32 bins) on nested fractions."""
    train, test = train_and_test(table)
    return models.nested_learning_curve(train.drop("classWeights"), test, KEY, FRACTIONS, seed=SEED)


def fraction_rows(table: DataFrame) -> DataFrame:
    """(fraction, side, n, n_positive): what the learning curve learns from and is measured on."""
    rows = model_rows(table)
    out = []
    for frac in FRACTIONS:
        part = features.hash_split(features.subsample(rows, frac, KEY, SEED), KEY, 80, SEED)
        side = F.when(F.col("is_train"), "train").otherwise("test").alias("side")
        out.append(part.groupBy(side).agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("long").alias("n_positive")).withColumn("fraction", F.lit(frac)))
    return reduce(DataFrame.unionByName, out).select("fraction", "side", "n", "n_positive")


def tuned(table: DataFrame) -> DataFrame:
    """Metrics of the tuned logistic model on train and test, and of every fold and point of the grid (``side`` = fold 0, ...)."""
    train, test = train_and_test(table)
    cv = models.tune(models.logistic(threshold=0.6), train, {"regParam": [0.0, 1.0], "maxIter": [100]}, folds=3, seed=SEED, fold_key=KEY, keep_models=True)
    best = models.best_parameters(cv, ["regParam", "maxIter"])
    whole = models.train_and_test_metrics(cv.bestModel, train, test).withColumns({k: F.lit(v) for k, v in best.items()})
    folds = models.fold_scores(cv, train, KEY, SEED).withColumn("side", F.concat(F.lit("fold "), F.col("fold").cast("string"))).drop("fold")
    return whole.unionByName(folds)


def gradient(table: DataFrame) -> DataFrame:
    """(slot, gradient) at the logistic model without regularisation, fitted to the end: near zero for every slot."""
    train, _ = train_and_test(table)
    estimator = models.logistic(max_iter=500).setTol(1e-12)
    return models.log_loss_gradient(estimator.fit(train), train)


def curve_areas(table: DataFrame) -> DataFrame:
    """(model, side, average_precision, roc_auc) of the scores of the fitted basic models."""
    train, test = train_and_test(table)
    out = []
    for name, est in (("logistic", models.logistic(max_iter=50)), ("forest", models.forest(seed=SEED))):
        model = est.fit(train)
        for side, rows in (("train", train), ("test", test)):
            scored = stage(model.transform(rows).select("label", F.element_at(vector_to_array("probability"), 2).alias("score")))
            area = evaluate.roc_auc(scored, "label", "score").select("roc_auc").scalar()
            out.append(evaluate.average_precision(scored, "label", "score").withColumns({"roc_auc": area, "model": F.lit(name), "side": F.lit(side)}))
    return reduce(DataFrame.unionByName, out)


def roc_curve(table: DataFrame) -> DataFrame:
    """The ROC curve of the basic logistic model on the test side."""
    train, test = train_and_test(table)
    scored = models.logistic(max_iter=50).fit(train).transform(test)
    return evaluate.roc_curve(stage(scored.select("label", F.element_at(vector_to_array("probability"), 2).alias("score"))), "label", "score")
