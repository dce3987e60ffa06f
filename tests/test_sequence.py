import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aloft.operators import sequence
from conftest import SF_SMALL, rows


def T(h, m=0, day=1):
    return dt.datetime(2024, 1, day, h, m)


@pytest.fixture
def tie_chain(spark):
    # one entity with 5 events, two tied on all clocks; a null entity; a single-event entity
    data = [(1, "A", T(8), T(8, 5)), (2, "A", T(10), T(10, 2)), (3, "A", T(10), T(10, 2)),
            (4, "A", T(12), T(12, 30)), (5, "A", T(1, 0, 2), T(1, 10, 2)),
            (6, None, T(9), T(9)), (7, "B", T(9), T(9, 1))]
    return spark.createDataFrame(data, "id int, ent string, sched timestamp_ntz, actual timestamp_ntz")


@pytest.mark.parametrize("split", ["day", "hour", "minute", None])
def test_ties_one(tie_chain, split):
    out = sequence.with_previous(tie_chain, "ent", ["sched", "actual"], ["id"], prefix="p_", tie_break=["id"],
                                 split=split)
    assert rows(out, "id", "p_id") == [(2, 1), (3, 2), (4, 3), (5, 4)]


@pytest.mark.parametrize("split", ["day", "hour", "minute", None])
def test_ties_all_fans_out(tie_chain, split):
    # D3: both tied events pair with the previous tuple, and the next event pairs with both
    out = sequence.with_previous(tie_chain, "ent", ["sched", "actual"], ["id"], prefix="p_", ties="all", split=split)
    assert rows(out, "id", "p_id") == [(2, 1), (3, 1), (4, 2), (4, 3), (5, 4)]


def test_keep_first(tie_chain):
    out = sequence.with_previous(tie_chain, "ent", ["sched", "actual"], ["id"], prefix="p_", tie_break=["id"],
                                 keep_first=True)
    assert rows(out, "id", "p_id") == [(1, None), (2, 1), (3, 2), (4, 3), (5, 4), (6, None), (7, None)]


def test_equals_rank_self_join_on_lineitem(spark):
    # the source's literal form: dense_rank newest-first, self-join on rank + 1
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("l_shipdate"))
    r = li.withColumn("rk", F.dense_rank().over(w))
    p = r.select(F.col("l_suppkey").alias("ps"), (F.col("rk") - 1).alias("prk"),
                 F.col("l_orderkey").alias("prev_l_orderkey"), F.col("l_linenumber").alias("prev_l_linenumber"))
    lit = r.join(p, (r.l_suppkey == p.ps) & (r.rk == p.prk)).select(
        "l_orderkey", "l_linenumber", "prev_l_orderkey", "prev_l_linenumber")
    ours = sequence.with_previous(li, "l_suppkey", ["l_shipdate"], ["l_orderkey", "l_linenumber"],
                                  prefix="prev_", ties="all").select(
        "l_orderkey", "l_linenumber", "prev_l_orderkey", "prev_l_linenumber")
    assert ours.count() == lit.count()
    assert ours.exceptAll(lit).count() == 0 and lit.exceptAll(ours).count() == 0


def test_segments_cross_day_boundaries(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    a = sequence.with_previous(ev, "user_id", ["ts"], ["event_id"], tie_break=["event_id"], split="day")
    b = sequence.with_previous(ev, "user_id", ["ts"], ["event_id"], tie_break=["event_id"], split=None)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    c = ev.withColumn("PREV_event_id", F.lag("event_id").over(w)).where(F.col("PREV_event_id").isNotNull())
    cols = ["event_id", "PREV_event_id"]
    assert rows(a, *cols) == rows(b, *cols) == rows(c, *cols)


@pytest.mark.parametrize("clock", ["timestamp", "timestamp_ntz", "date"])
def test_every_clock_type_is_split(spark, clock):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("c", F.col("ts").cast(clock))
    a = sequence.with_previous(ev, "user_id", ["c", "event_id"], ["event_id"], tie_break=["event_id"])
    b = sequence.with_previous(ev, "user_id", ["c", "event_id"], ["event_id"], tie_break=["event_id"], split=None)
    assert rows(a, "event_id", "PREV_event_id") == rows(b, "event_id", "PREV_event_id")
    windows = [x for x in a._jdf.queryExecution().analyzed().toString().splitlines() if "windowspecdefinition" in x and "row_number" in x]
    assert windows and all("__seg" in x for x in windows)


def test_null_entities_stay_outside_the_window(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("u", F.when(F.col("event_id") % 3 > 0, F.col("user_id")))
    for ties in ("one", "all"):
        out = sequence.with_previous(ev, "u", ["ts", "event_id"], ["event_id"], tie_break=["event_id"], keep_first=True, ties=ties)
        assert out.count() == ev.count()
        assert out.where("u is null and PREV_event_id is not null").count() == 0


@pytest.mark.parametrize("clock", ["bigint", "double", "decimal(20,3)", "string"])
def test_clocks_without_an_hour_are_split_by_sampled_ranges(spark, clock):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev = ev.withColumn("c", F.date_format(F.col("ts").cast("timestamp"), "yyyyMMddHHmm") if clock == "string" else seconds.cast(clock))
    ev = ev.withColumn("u", F.when(F.col("event_id") % 3 > 0, F.lit(-1)).otherwise(F.col("user_id")))       # a hot entity
    for ties in ("one", "all"):
        a = sequence.with_previous(ev, "u", ["c", "event_id"], ["event_id"], tie_break=["event_id"], ties=ties)
        b = sequence.with_previous(ev, "u", ["c", "event_id"], ["event_id"], tie_break=["event_id"], ties=ties, split=None)
        assert rows(a, "event_id", "PREV_event_id") == rows(b, "event_id", "PREV_event_id")
    seg = sequence._with_range_segment(ev, "u", ["c"])
    assert seg.groupBy("u", "__seg").count().agg(F.max("count")).first()[0] < 0.05 * ev.count()
    assert sequence.with_previous(ev.where("false"), "u", ["c"], ["event_id"], tie_break=["event_id"]).count() == 0
