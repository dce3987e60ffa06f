"""The study's ETL end to end on sf0.001."""

from pyspark.sql import functions as F

from aloft.functions.clock import hour_start
from aloft.operators import interval, nearest
from aloft.plans import bindings as b
from aloft.plans import flight_study as fs
from aloft.sources.io import clear_stages, stage, stage_bucketed
from conftest import SF_SMALL


def _zones(spark):
    return b.study_state_tz(spark), b.study_city_tz(spark)


def test_feature_table_shape(spark):
    tb = fs.TestBinding()
    flights = b.study_flights(spark, SF_SMALL)
    out = fs.feature_table(flights, b.study_observations(spark, SF_SMALL), b.study_places(spark, SF_SMALL),
                           *_zones(spark), tb.fspec, tb.ospec)
    n = out.count()
    assert out.columns == list(fs.FINAL) and len(fs.FINAL) == 54
    assert 0 < n <= flights.count()
    assert out.select("FLIGHT_IDX").distinct().count() == n                       # one row per kept flight
    for c in fs.DROP_IF_NULL:
        assert out.where(F.col(c).isNull()).count() == 0, c
    assert out.where((F.col("DEP_DELAY") <= -45) | (F.col("PREV_ARR_DELAY") <= -81) | (F.col("PREV_CRS_ELAPSED_TIME") <= 18)).count() == 0
    assert set(out.select("BLOCK6").distinct().toPandas()["BLOCK6"]) <= {0, 1}
    assert "Pacific/Guam" not in {r[0] for r in out.select("ORIGIN_TIMEZONE").distinct().collect()}   # its place has no altitude


def test_traffic_counts_first_flights_and_flights_without_a_tail_number(spark):
    cols = [*fs.FLIGHT_COLUMNS, "YEAR", "DAY_OF_MONTH", "DEP_TIME", "CRS_ARR_TIME", "ARR_TIME", "CANCELLED"]

    def flight(i, tail, dep, cancelled=0.0):
        v = dict.fromkeys(cols, "x") | {"FLIGHT_IDX": i, "TAIL_NUM": tail, "ORIGIN": "AAA", "YEAR": 2024, "MONTH": 5, "DAY_OF_MONTH": 1,
             "CRS_DEP_TIME": dep, "DEP_TIME": dep, "CRS_ARR_TIME": "1500", "ARR_TIME": "1500", "CANCELLED": cancelled, "CRS_ELAPSED_TIME": 60.0,
             "DEP_DELAY": 10.0 * i, "DEP_DELAY_NEW": 10.0 * i, "DEP_DEL15": i % 2, "ARR_DELAY": 0.0, "ARR_DELAY_NEW": 0.0, "ARR_DEL15": 0}
        return tuple(v[c] for c in cols)

    rows = [flight(1, "N1", "0800"), flight(2, None, "0815"), flight(3, "N2", "0830"), flight(4, "N3", "0845", 1.0), flight(5, "N1", "1010")]
    schema = ", ".join(f"{c} {'string' if isinstance(v, str) else 'int' if isinstance(v, int) else 'double'}"
                       for c, v in zip(cols, rows[0], strict=True))
    places = spark.createDataFrame([("AAA", "40", "-100", "5")], "IATA string, Latitude string, Longitude string, Altitude string")
    done = fs.completed_flights(spark.createDataFrame(rows, schema))
    r = fs.prepare_flights(done, fs.FlightSpec(), places, *_zones(spark)).collect()
    assert [x.FLIGHT_IDX for x in r] == [5] and r[0].PREV_FLIGHT_IDX == 1
    # 8 o'clock had three completed flights, two of them delayed
    assert (r[0].HOURLY_NUM_OF_FLIGHTS, r[0].HOURLY_NUM_OF_DELAY) == (3, 2)
    assert (r[0].HOURLY_MINUTE_OF_DELAY, r[0].PREP_TIME) == (20.0, 70.0)


def test_order_of_the_spec_is_used(spark):
    done = fs.completed_flights(b.study_flights(spark, SF_SMALL))
    places = b.study_places(spark, SF_SMALL)
    one = fs.prepare_flights(done, fs.FlightSpec(), places, *_zones(spark)).select("FLIGHT_IDX", "PREV_FLIGHT_IDX")
    other = fs.prepare_flights(done, fs.FlightSpec(order=("ARR_LOCAL",)), places, *_zones(spark)).select("FLIGHT_IDX", "PREV_FLIGHT_IDX")
    assert one.exceptAll(other).count() > 0


def test_weather_matches_per_flight_are_bounded(spark):
    # a flight sees at most k stations, each with the readings of one open 1-hour window,
    # which spans at most two calendar hours
    tb = fs.TestBinding()
    places = b.study_places(spark, SF_SMALL)
    f = fs.prepare_flights(fs.completed_flights(b.study_flights(spark, SF_SMALL), tb.fspec), tb.fspec, places, *_zones(spark))
    w = fs.clean_observations(b.study_observations(spark, SF_SMALL), tb.ospec)
    near = nearest.nearest_k(places, w.select("STATION_ID", "STATION_LAT", "STATION_LON"), "IATA", "Latitude",
                             "Longitude", "STATION_ID", "STATION_LAT", "STATION_LON", k=fs.NEAREST_K,
                             max_km=fs.NEAREST_MAX_KM)
    assert near.groupBy("IATA").count().agg(F.max("count")).first()[0] <= fs.NEAREST_K
    fl = f.select("FLIGHT_IDX", F.col("ORIGIN").alias("IATA"), "CRS_DEP_UTC").join(near.select("IATA", "STATION_ID"), "IATA")
    r = w.select(F.col("STATION_ID").alias("R"), "READING_TS")
    m = interval.interval_join(fl, r, "STATION_ID", "R", "CRS_DEP_UTC", "READING_TS", lo=fs.WINDOW_LO, hi=fs.WINDOW_HI)
    per_flight = m.groupBy("FLIGHT_IDX").count().agg(F.max("count")).first()[0] or 0
    per_hour = w.groupBy("STATION_ID", hour_start("READING_TS")).count().agg(F.max("count")).first()[0]
    assert 0 < per_flight <= fs.NEAREST_K * 2 * per_hour
    joined = fs.weather_for_flights(f, w, places)
    assert joined.count() == f.count()                                      # attach is a left join


def test_bucketed_stages_are_read_without_an_exchange(spark):
    tb = fs.TestBinding()
    places = b.study_places(spark, SF_SMALL)
    f = fs.prepare_flights(fs.completed_flights(b.study_flights(spark, SF_SMALL), tb.fspec), tb.fspec, places, *_zones(spark))
    w = fs.clean_observations(b.study_observations(spark, SF_SMALL), tb.ospec)
    binned = w.withColumn(fs.BIN, interval.bin_of("READING_TS"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    held = {k: spark.conf.get(k) for k in conf}
    plain = fs.weather_for_flights(stage(f), stage(w), places)
    bucketed = fs.weather_for_flights(stage_bucketed(f, ["FLIGHT_IDX"]), stage_bucketed(binned, ["STATION_ID", fs.BIN]), places)
    assert bucketed.columns == plain.columns
    assert bucketed.exceptAll(plain).count() == 0 and plain.exceptAll(bucketed).count() == 0
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = [fs.weather_for_flights(stage_bucketed(f, ["FLIGHT_IDX"]), stage_bucketed(binned, ["STATION_ID", fs.BIN]), places),
                fs.weather_for_flights(stage(f), stage(w), places)]
        wide = [p._jdf.queryExecution().executedPlan().toString() for p in plan]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    # the wide sides: attaching to the flights, and the readings of a station's hour
    sides = [_exchanged(p, "TAIL_NUM") + _exchanged(p, "READING_TS") for p in wide]
    assert sides == [0, 2], wide


def _exchanged(plan: str, column: str) -> int:
    """Exchanges right above a scan of ``column`` (with only projections, filters and sorts between)."""
    found, above = 0, ""
    for line in plan.splitlines():
        node = line.lstrip(" :+-*()0123456789")
        if node.startswith("Exchange"):
            above = node
        elif node.startswith("FileScan"):
            found += bool(above) and column in node
            above = ""
        elif not node.startswith(("Project", "Filter", "Sort ", "ColumnarToRow", "Generate")):
            above = ""
    return found


def test_bucketed_stage(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    t = stage_bucketed(ev, ["user_id", "event_type"], 4)
    assert t.count() == ev.count() and t.select(*ev.columns).exceptAll(ev).count() == 0
    assert len(t.inputFiles()) <= 4
    counted = t.groupBy("event_type", "user_id").count()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    empty = stage_bucketed(ev.where("false"), ["user_id"])
    assert empty.count() == 0 and empty.columns == ev.columns
    before = spark.sql("show tables like 'aloft_bucketed*'").count()
    assert before >= 2 and clear_stages(spark) >= 2 and spark.sql("show tables like 'aloft_bucketed*'").count() == 0
