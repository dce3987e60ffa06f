import os
import tempfile

from pyspark.sql import functions as F

from aloft.plans import bindings
from aloft.plans.catalog import QUERIES
from aloft.operators import traffic
from aloft.session import scratch_path
from aloft.streaming.traffic import hourly_rate_stream
from conftest import SF_SMALL, rows

MODEL = {"logistic_scores", "logistic_threshold", "logistic_tuned", "forest_scores", "forest_importance",
         "forest_selected", "learning_curve", "logistic_fold_scores", "study_features", "study_model", "csv_named_roundtrip",
         "study_selected", "study_learning_curve", "study_tuned", "study_gradient", "study_roc_curve"}
# these write a bounded table on the way: sketches and order statistics, over-full cells, numbered rows, a Gram matrix, partitions
STAGED = {"group_median", "impute_by_group", "box_summary", "tail_bounds", "haversine_pairs", "dense_pairs", "nearest_three", "stable_row_key",
          "correlation_matrix", "rate_sink_restart", "study_correlation", "study_importance", "study_fraction_rows", "study_curve_areas"}
# index_categories and onehot_features fit an indexer, class_weights and gini_by_feature read one ratio
FITTED = MODEL | STAGED | {"index_categories", "onehot_features", "class_weights"}


def test_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="aloft-stream-src-")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("delayed", (F.col("value") > 80).cast("int"))
    ev.repartition(4).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    q = (hourly_rate_stream(stream, "event_type", "ts", "delayed", {"value": "mean_value"}, watermark="1000 days",
                            bucket="hb", count_name="n", flagged_name="k", rate_name="r")
         .writeStream.format("memory").queryName("aloft_rate_stream").outputMode("complete")
         .option("checkpointLocation", scratch_path(spark, "stream-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("aloft_rate_stream").select("event_type", "hb", "n", "k", F.round("r", 9), F.round("mean_value", 9))
    batch = traffic.hourly_rate(ev, "event_type", "ts", "delayed", {"value": "mean_value"}, lag="2 hours",
                                bucket="hb", count_name="n", flagged_name="k", rate_name="r") \
        .select("event_type", "hb", "n", "k", F.round("r", 9), F.round("mean_value", 9))
    assert rows(got) == rows(batch)


def test_no_cross_join_or_python_in_plans(spark):
    for name, fn in QUERIES.items():
        if name in MODEL:
            continue
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_building_a_query_runs_no_job(spark, monkeypatch):
    reads, table = [], bindings.table
    monkeypatch.setattr(bindings, "table", lambda *a: reads.append(a) or table(*a))
    tracker = spark.sparkContext.statusTracker()
    for name, fn in QUERIES.items():
        if name in FITTED:
            continue
        reads.clear()
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        fn(spark, SF_SMALL)
        jobs = tracker.getJobIdsForGroup(f"build-{name}")
        assert len(jobs) <= len(reads), (name, len(jobs))          # Spark reads one footer per scan for its schema
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
