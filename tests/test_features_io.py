import os
import tempfile

import pytest
from pyspark.sql import functions as F

from aloft.operators import features, models
from aloft.sources import io
from conftest import SF_SMALL


def test_hash_split_disjoint_complete_stable(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    tr, te = features.split(ev, "event_id", 80, seed=3)
    n, a, b = ev.count(), tr.count(), te.count()
    assert a + b == n and tr.join(te, "event_id").count() == 0
    assert 0.7 < a / n < 0.9
    tr2, _ = features.split(ev.repartition(7), "event_id", 80, seed=3)
    assert tr.select("event_id").exceptAll(tr2.select("event_id")).count() == 0


def test_subsample_fraction(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    frac = features.subsample(ev, 0.25, "event_id").count() / ev.count()
    assert 0.18 < frac < 0.32


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    w = dict((r.y, r.classWeights) for r in features.class_weights(df, "y").distinct().collect())
    assert w == {1: 0.75, 0: 0.25}


def test_features_fit_on_train_keep_unseen(spark):
    train = spark.createDataFrame([("a", 1.0, 0.0), ("a", 2.0, 1.0), ("b", 3.0, 0.0)], "c string, x double, label double")
    test = spark.createDataFrame([("z", 5.0, 1.0)], "c string, x double, label double")
    model, _ = features.build_features(train, ["x"], ["c"])
    out = model.transform(test).select("features").first()[0].toArray().tolist()
    # slots: a, b, unseen (keep), then x
    assert out == [0.0, 0.0, 1.0, 5.0]
    names = [n for _, n in features.feature_names(model.transform(train))]
    assert names[-1] == "x" and len(names) == 4


def test_forest_importance_table(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    d = li.select("l_quantity", "l_discount", (F.col("l_returnflag") == "R").cast("double").alias("label"))
    d = features.class_weights(d, "label")
    _, df = features.build_features(d, ["l_quantity", "l_discount"])
    m = models.forest(trees=3, depth=3).fit(df)
    imp = features.feature_importance(spark, m, df)
    rows = imp.collect()
    assert [r.name for r in rows] and abs(sum(r.score for r in rows) - 100.0) < 1e-6


def test_write_table_fails_if_exists_and_csv_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="aloft-test-")
    path = os.path.join(d, "t")
    nat = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    io.write_table(nat, path, fmt="csv", header="false")
    with pytest.raises(Exception):
        io.write_table(nat, path, fmt="csv")
    back = io.read_csv_named(spark, path, ["k", "name", "r"])
    assert back.count() == 25 and [f.dataType.simpleString() for f in back.schema.fields] == ["string"] * 3


def test_stage_and_dims(spark):
    nat = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    staged = io.stage(nat.where("n_regionkey = 1"))
    assert staged.count() == 5 and "FileScan" in staged._jdf.queryExecution().executedPlan().toString()
    dim = io.dim_table(spark, [(1, "x")], "k int, v string")
    assert dim.count() == 1
    path = staged.inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path.replace("///", "/")) and io.clear_stages(spark) > 0
    assert not os.path.exists(os.path.dirname(path.replace("///", "/"))) and io.clear_stages(spark) == 0


def test_expect_schema(spark):
    nat = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    io.expect_schema(nat, {"n_nationkey": "int", "n_name": "string"})
    with pytest.raises(ValueError):
        io.expect_schema(nat, {"n_nationkey": "bigint"})


def test_persist_reuse_cache(spark):
    nat = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    p = io.persist(nat)
    try:
        assert p.count() == 25 and p.storageLevel.useDisk and p.storageLevel.useMemory
    finally:
        p.unpersist()


def test_a_partition_is_replaced_and_pruned(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "value", F.pmod("event_id", F.lit(5)).cast("int").alias("day"))
    path = io.scratch_path(spark, "test-days")
    for part in (ev, ev.where("day = 2"), ev.where("day in (2, 4)")):
        io.replace_partitions(part, path, ["day"])
    back = spark.read.parquet(path).select(*ev.columns)
    assert back.count() == ev.count() and back.exceptAll(ev).count() == 0
    io.replace_partitions(ev.where("day = 3 and value > 50"), path, ["day"])
    assert spark.read.parquet(path).where("day = 3 and value <= 50").count() == 0 and spark.read.parquet(path).where("day = 1").count() > 0
    days = spark.range(5).select(F.col("id").cast("int").alias("day")).where(F.rand(1) >= 0)
    joined = spark.read.parquet(path).join(F.broadcast(io.stage(days).where("day < 2")), "day")
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
