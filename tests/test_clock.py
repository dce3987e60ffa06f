import datetime as dt

from pyspark.sql import functions as F

from aloft.functions import clock
from conftest import rows


def T(*a):
    return dt.datetime(*a)


def test_hhmm_edges(spark):
    # clock_edges fixture: 0, 5, 59, 100, 1530, 2359, 2400, null, and 2400 at a month end
    data = [(2020, 1, 15, 0), (2020, 1, 15, 5), (2020, 1, 15, 59), (2020, 1, 15, 100), (2020, 1, 15, 1530),
            (2020, 1, 15, 2359), (2020, 1, 15, 2400), (2020, 1, 15, None), (2020, 1, 31, 2400), (2020, 1, 15, 1575)]
    df = spark.createDataFrame(data, "y int, m int, d int, hhmm int")
    out = df.select("hhmm", "d", clock.hhmm_to_ts("y", "m", "d", "hhmm").alias("nx"),
                    clock.hhmm_to_ts("y", "m", "d", "hhmm", rollover="same_day").alias("sd"))
    got = {(r.hhmm, r.d): (r.nx, r.sd) for r in out.collect()}
    assert got[(0, 15)] == (T(2020, 1, 15, 0, 0), T(2020, 1, 15, 0, 0))
    assert got[(5, 15)][0] == T(2020, 1, 15, 0, 5)
    assert got[(59, 15)][0] == T(2020, 1, 15, 0, 59)
    assert got[(100, 15)][0] == T(2020, 1, 15, 1, 0)
    assert got[(1530, 15)][0] == T(2020, 1, 15, 15, 30)
    assert got[(2359, 15)][0] == T(2020, 1, 15, 23, 59)
    assert got[(2400, 15)] == (T(2020, 1, 16, 0, 0), T(2020, 1, 15, 0, 0))      # D1
    assert got[(2400, 31)] == (T(2020, 2, 1, 0, 0), T(2020, 1, 31, 0, 0))       # month end
    assert got[(None, 15)] == (None, None)
    assert got[(1575, 15)] == (None, None)                                       # impossible minute


def test_minutes_between_signed_and_wrapped(spark):
    # gap_edges fixture: +95 min, -120 min, +26 h, null, and -119:01 (seconds present)
    base = T(2020, 5, 1, 12, 0)
    data = [(base + dt.timedelta(minutes=95), base), (base - dt.timedelta(minutes=120), base),
            (base + dt.timedelta(hours=26), base), (None, base),
            (base - dt.timedelta(minutes=119, seconds=1), base)]
    df = spark.createDataFrame(data, "a timestamp_ntz, b timestamp_ntz")
    out = df.select(clock.minutes_between("a", "b").alias("s"), clock.minutes_between("a", "b", True).alias("w"))
    got = [tuple(r) for r in out.collect()]
    assert got == [(95, 95), (-120, 1320), (1560, 120), (None, None), (-119, 1320)]


def test_shift_label_floor_block(spark):
    df = spark.createDataFrame([(T(2024, 1, 1, 1, 30, 15),), (T(2024, 1, 1, 23, 59, 59),), (None,)], "ts timestamp_ntz")
    out = df.select(clock.hour_label(clock.shift("ts", "2 hours")).alias("h"), clock.hour_start("ts").alias("s"),
                    clock.day_block("ts").alias("b"), clock.floor_to("ts", "day").alias("d"))
    got = [tuple(r) for r in out.collect()]
    assert got[0] == ("2024-01-01 03", T(2024, 1, 1, 1, 0), "2023-12-31 night", T(2024, 1, 1))
    assert got[1] == ("2024-01-02 01", T(2024, 1, 1, 23, 0), "2024-01-01 night", T(2024, 1, 1))
    assert got[2] == (None, None, None, None)


def test_day_block_boundaries(spark):
    # blocks of ts - 150 min: 0-6 early, 6-12 morning, 12-18 afternoon, 18-24 night
    ts = [T(2024, 3, 2, 2, 30), T(2024, 3, 2, 8, 29), T(2024, 3, 2, 8, 30), T(2024, 3, 2, 14, 30), T(2024, 3, 2, 20, 30)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    got = [r[0] for r in df.select(clock.day_block("ts")).collect()]
    assert got == ["2024-03-02 early", "2024-03-02 early", "2024-03-02 morning", "2024-03-02 afternoon",
                   "2024-03-02 night"]


def test_to_utc_independent_of_session_zone(spark):
    df = spark.createDataFrame([(T(2024, 7, 1, 12, 0), "America/New_York"), (T(2024, 1, 1, 12, 0), "America/New_York"),
                                (T(2024, 1, 1, 12, 0), None), (T(2024, 1, 1, 12, 0), "Asia/Tokyo")],
                               "ts timestamp_ntz, tz string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        res = []
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            res.append([r[0] for r in df.select(clock.to_utc("ts", "tz")).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert res[0] == res[1] == [T(2024, 7, 1, 16, 0), T(2024, 1, 1, 17, 0), None, T(2024, 1, 1, 3, 0)]


def test_floor_to_ignores_session_dst(spark):
    # 02:30 on 2024-03-10 does not exist in Los Angeles; a naive floor must still give 02:00
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(T(2024, 3, 10, 2, 30),)], "ts timestamp_ntz")
        assert df.select(clock.hour_start("ts")).first()[0] == T(2024, 3, 10, 2, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
