import datetime as dt

import pytest
from pyspark.sql import functions as F

from aloft.operators import interval, traffic
from conftest import SF_SMALL, rows


def T(h, m=0, s=0, day=1):
    return dt.datetime(2024, 1, day, h, m, s)


@pytest.fixture
def lag_hours(spark):
    # 3 places, events on both sides of midnight, an hour with no traffic two hours before
    data = [(1, "P", T(22, 10), 1), (2, "P", T(22, 40), 0), (3, "P", T(0, 15, day=2), 1), (4, "P", T(0, 50, day=2), 0),
            (5, "Q", T(23, 5), 0), (6, "Q", T(1, 5, day=2), 1), (7, "R", T(5, 0), 1), (8, "R", T(7, 30), 0),
            (9, "P", T(1, 0, day=2), 1), (10, "Q", T(3, 59, day=2), 0)]
    return spark.createDataFrame(data, "id int, place string, ts timestamp_ntz, flag int")


def test_hourly_rate_values(lag_hours):
    h = traffic.hourly_rate(lag_hours, "place", "ts", "flag", lag="2 hours", bucket="b", count_name="n",
                            flagged_name="k", rate_name="r")
    got = {(r.place, r.b): (r.n, r.k, r.r) for r in h.collect()}
    assert got[("P", T(0, 0, day=2))] == (2, 1, 0.5)      # 22:10 and 22:40 keyed two hours later
    assert got[("P", T(2, 0, day=2))] == (2, 1, 0.5)
    assert got[("P", T(3, 0, day=2))] == (1, 1, 1.0)


def test_lagged_rate_keeps_rows_and_matches(lag_hours):
    out = traffic.with_lagged_rate(lag_hours, "place", "ts", "flag", count_name="n", flagged_name="k", rate_name="r")
    assert out.count() == lag_hours.count()                  # never multiplies rows
    got = {r.id: (r.n, r.r) for r in out.collect()}
    assert got[3] == (2, 0.5) and got[4] == (2, 0.5)        # 00:xx sees 22:xx of the previous day
    assert got[6] == (1, 0.0)                               # Q at 01:05 sees Q at 23:05
    assert got[7] == (None, None)                           # no traffic two hours earlier
    assert got[8] == (1, 1.0)                               # 07:30 sees the 05:00 hour
    assert got[9] == (None, None)                           # 01:00 -> 23:00: no P traffic then
    assert got[10] == (1, 1.0)


@pytest.fixture
def window_edges(spark):
    left = spark.createDataFrame([(1, "S", T(12)), (2, "S", None), (3, "X", T(12))],
                                 "id int, st string, t timestamp_ntz")
    right = spark.createDataFrame([(10, "S", T(9, 0)), (11, "S", T(10, 0)), (12, "S", T(9, 0, 1)), (13, "S", T(9, 59, 59)),
                                   (14, "S", T(8, 59)), (15, "S", T(10, 1)), (16, "Y", T(9, 30)), (17, "S", None)],
                                  "rid int, rst string, rt timestamp_ntz")
    return left, right


def test_open_bounds(window_edges):
    left, right = window_edges
    out = interval.interval_join(left, right, "st", "rst", "t", "rt")
    assert rows(out, "id", "rid") == [(1, 12), (1, 13)]     # ends excluded, 1 s inside included


def test_closed_bounds(window_edges):
    left, right = window_edges
    out = interval.interval_join(left, right, "st", "rst", "t", "rt", closed="both")
    assert rows(out, "id", "rid") == [(1, 10), (1, 11), (1, 12), (1, 13)]


@pytest.mark.parametrize("width", ["1 hour", "20 minutes", "7 hours", "1 day"])
def test_any_bin_width_equals_plain_join(spark, width):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    left = ev.select("event_id", "event_type", "ts")
    right = ev.select(F.col("event_id").alias("rid"), F.col("event_type").alias("rtype"), F.col("ts").alias("rts"))
    ours = interval.interval_join(left, right, "event_type", "rtype", "ts", "rts", bin_width=width) \
        .select("event_id", "rid")
    plain = left.join(right, (left.event_type == right.rtype) & (right.rts > left.ts - F.expr("INTERVAL 3 HOURS"))
                      & (right.rts < left.ts - F.expr("INTERVAL 2 HOURS"))).select("event_id", "rid")
    assert ours.count() == plain.count()
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0
