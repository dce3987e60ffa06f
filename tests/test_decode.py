from pyspark.sql import functions as F

from aloft.functions import decode


def _one(spark, col, values, names):
    df = spark.createDataFrame([(v,) for v in values], f"{col} string")
    specs = [decode.field_spec(n) for n in names]
    return [tuple(r) for r in decode.decode_observations(df, specs, drop_sources=False).select(*names).collect()]


def test_wind_quality_codes_and_sentinels(spark):
    # wx_codes fixture: every quality code 0-9 on the angle, the speed sentinel, malformed values
    vals = [f"160,{q},N,0046,1" for q in range(10)] + ["999,1,N,0046,1", "160,1,N,9999,1", "160,1,N,0046",
                                                       "", None, "1x0,1,N,0046,1", "160,1,N,+046,5"]
    got = _one(spark, "WND", vals, ["WindAngle", "WindSpeed"])
    for q in range(10):
        assert got[q] == ((None if str(q) in decode.BAD_QUALITY else 160), 46)
    assert got[10] == (None, 46)        # angle sentinel 999
    assert got[11] == (160, None)       # speed sentinel 9999
    assert got[12] == (None, None)      # too few parts: malformed
    assert got[13] == (None, None)      # empty
    assert got[14] == (None, None)      # null
    assert got[15] == (None, 46)        # text in number
    assert got[16] == (160, 46)         # signed number, quality 5 is fine


def test_temperature_scale_and_sentinel(spark):
    got = _one(spark, "TMP", ["+0123,1", "-0093,1", "+9999,9", "+0123,2", "+0123"], ["Temperature"])
    assert [g[0] for g in got] == [12.3, -9.3, None, None, None]


def test_visibility_parity_flag(spark):
    # The source substitutes 99999 for bad-quality visibility, which survives the 999999 sentinel
    df = spark.createDataFrame([("016093,2,N,1",), ("999999,1,N,1",), ("016093,1,N,1",)], "VIS string")
    spec = [decode.field_spec("Visibility")]
    fixed = [r[0] for r in decode.decode_observations(df, spec).collect()]
    parity = [r[0] for r in decode.decode_observations(df, spec, strict_parity=True).collect()]
    assert fixed == [None, None, 16093]
    assert parity == [99999, None, 16093]


def test_cloud_empty_means_missing(spark):
    got = _one(spark, "GD1", ["4,99,1,+00457,1,9", "", "9,99,1,+00457,1,9", "4,99,2,+00457,3,9", "4,99,1"],
               ["CloudMode", "CloudHeight"])
    assert got == [(4, 457), (None, None), (None, 457), (None, None), (None, None)]


def test_condition_first_nonempty(spark):
    # An empty first group falls through to the next one by default
    df = spark.createDataFrame([("", "61,1"), (None, "61,1"), ("71,5", "61,1"), ("", None), ("80,2", None)],
                               "AW1 string, AW2 string")
    spec = [decode.field_spec("AtmCondition")]
    fixed = df.withColumn("AW", decode.first_nonempty(["AW1", "AW2"]))
    parity = df.withColumn("AW", decode.first_nonempty(["AW1", "AW2"], skip_empty=False))
    assert [r[0] for r in decode.decode_observations(fixed, spec).select("AtmCondition").collect()] == [61, 61, 71, None, None]
    assert [r[0] for r in decode.decode_observations(parity, spec).select("AtmCondition").collect()] == [None, 61, 71, None, None]


def test_region_filter_and_name_state(spark):
    names = ["CHICAGO OHARE, IL US", "GUAM INTL, GU GQ", "TORONTO, ON CA", "FOO, X, AK US", "NOCOMMA",
             "TWO  SPACES,  AK US", None, "A, AK US EXTRA"]
    df = spark.createDataFrame([(n,) for n in names], "NAME string")
    kept = df.where(decode.region_predicate("NAME")).withColumns(decode.station_name_state("NAME"))
    got = [tuple(r) for r in kept.select("NAME", "StationName", "State").collect()]
    # blanks around the location are stripped, so the two-space name is kept
    assert got == [("CHICAGO OHARE, IL US", "CHICAGO OHARE", "IL"), ("GUAM INTL, GU GQ", "GUAM INTL", "GU"),
                   ("TWO  SPACES,  AK US", "TWO  SPACES", "AK")]


def test_reject_report_partitions_rows(spark):
    vals = ["160,1,N,0046,1", "160,2,N,0046,1", "999,1,N,0046,1", "bad", None, "160,1,N,9999,1"]
    df = spark.createDataFrame([(v,) for v in vals], "WND string")
    rep = {r["field"]: r for r in decode.reject_report(df, [decode.field_spec("WindAngle"),
                                                          decode.field_spec("WindSpeed")]).collect()}
    a = rep["WindAngle"]
    assert (a.n_rows, a.n_null_source, a.n_malformed, a.n_empty, a.n_bad_quality, a.n_sentinel, a.n_valid) == \
        (6, 1, 1, 0, 1, 1, 2)
    s = rep["WindSpeed"]
    assert s.n_sentinel == 1 and s.n_valid == 3
    for r in rep.values():
        assert r.n_null_source + r.n_malformed + r.n_empty + r.n_bad_quality + r.n_sentinel + r.n_valid == r.n_rows
