import datetime as dt

from pyspark.sql import functions as F

from aloft.functions import clock
from aloft.operators import clean, enrich, nearest


def test_unknown_zone_gives_null(spark):
    df = spark.createDataFrame([("Europe/Berlin",), ("Mars/Base",), (None,), ("",)], "tz string") \
        .withColumn("t", F.lit("2024-07-01 12:00:00").cast("timestamp_ntz"))
    assert [r.u for r in df.select(clock.to_utc("t", "tz").alias("u")).collect()] == [dt.datetime(2024, 7, 1, 10), None, None, None]


def test_hhmm_text(spark):
    df = spark.createDataFrame([("0830",), ("2400",), ("abc",), (None,), ("1275",)], "h string")
    got = [r.t for r in df.select(clock.hhmm_to_ts(F.lit(2024), F.lit("2"), F.lit(28), "h").alias("t")).collect()]
    assert got == [dt.datetime(2024, 2, 28, 8, 30), dt.datetime(2024, 2, 29), None, None, None]


def test_coordinate_text(spark):
    places = spark.createDataFrame([("a", "40.0", "-100"), ("b", "x", "-100"), ("c", None, "1")], "p string, lat string, lon string")
    sites = spark.createDataFrame([(1, "40.01", "-100.0"), (2, "north", "0")], "s int, lat string, lon string")
    out = nearest.pairs_within(places, sites, "p", "lat", "lon", "s", "lat", "lon", max_km=5.0)
    assert [(r.p, r.s) for r in out.collect()] == [("a", 1)]


def test_row_keys(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "b", None), ("ab", None, None), (None, None, None)], "x string, y string, z string")
    keys = [r.k for r in clean.with_row_key(df, "k", ["x", "y", "z"]).collect()]
    assert len(set(keys)) == 4 and all(len(k) == 32 for k in keys)
    assert len({r.k for r in clean.with_row_key(df, "k", ["x", "y", "z"], unique=True).collect()}) == 5


def test_a_repeated_state_multiplies_no_rows(spark):
    df = spark.createDataFrame([("NY", "x"), ("ZZ", "Guam, TT")], "s string, c string")
    st = spark.createDataFrame([("NY", "America/New_York"), ("NY", "America/New_York")], "s string, tz string")
    ct = spark.createDataFrame([("Guam, TT", "Pacific/Guam")] * 2, "c string, tz string")
    assert sorted(r.tz for r in enrich.attach_timezone(df, "s", "c", st, ct, out="tz").collect()) == ["America/New_York", "Pacific/Guam"]


def test_many_repeats_are_numbered_without_gaps(spark):
    rows = [("a", 1)] * 500 + [("b", i) for i in range(100)] + [(None, 2)] * 7
    df = spark.createDataFrame(rows, "x string, y int").repartition(5)
    out = clean.with_row_key(df, "k", ["x", "y"], unique=True).collect()
    assert len(out) == len({r.k for r in out}) == len(rows)
    numbers = sorted(int(r.k.split("-")[1]) if "-" in r.k else 1 for r in out if r.x == "a")
    assert numbers == list(range(1, 501))
