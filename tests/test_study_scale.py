"""What the study's table moves: usable readings, one summary per place and clock, no flights shuffled for a small table."""

import pytest
from pyspark.sql import functions as F

from aloft.plans import bindings as b
from aloft.plans import flight_study as fs
from aloft.plans import study_models as sm
from aloft.plans.catalog import QUERIES
from aloft.sources.io import stage, stage_bucketed
from conftest import SF_SMALL


def _inputs(spark):
    return (b.study_flights(spark, SF_SMALL), b.study_observations(spark, SF_SMALL), b.study_places(spark, SF_SMALL),
            b.study_state_tz(spark), b.study_city_tz(spark))


def test_only_usable_readings_are_written_and_flights_are_not_shuffled_for_small_tables(spark, monkeypatch):
    flights, obs, places, *zones = _inputs(spark)
    tb, bucketed, plans = fs.TestBinding(), [], []

    def keep(df):
        plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return stage(df)

    def keep_bucketed(df, keys):
        bucketed.append(stage_bucketed(df, keys))
        return bucketed[-1]

    monkeypatch.setattr(fs, "stage", keep)
    monkeypatch.setattr(fs, "stage_bucketed", keep_bucketed)
    assert fs.feature_table(flights, obs, places, *zones, tb.fspec, tb.ospec).count() > 0
    w = fs.clean_observations(obs, tb.ospec)
    near = fs.near_stations(places, w.select("STATION_ID", "STATION_LAT", "STATION_LON"))
    wanted = {r[0] for r in near.select("STATION_ID").collect()}
    (weather,) = [t for t in bucketed if "READING_TS" in t.columns]
    assert {r[0] for r in weather.select("STATION_ID").distinct().collect()} == wanted < {r[0] for r in w.select("STATION_ID").distinct().collect()}
    assert weather.count() == w.where(F.col("STATION_ID").isin(*wanted)).count()
    # the flights move once, to their aircraft; places, traffic and summaries come to them
    wide = [p for c, p in plans if "TAIL_NUM" in c and "AIRPORT_ALTITUDE" in c]
    assert len(wide) == 2 and not any("Exchange hashpartitioning(ORIGIN#" in p for p in wide), wide


def test_stations_are_those_of_the_cleaned_readings(spark):
    obs, tb = b.study_observations(spark, SF_SMALL), fs.TestBinding()
    obs = obs.withColumn("name", F.when(F.col("station") % 4 == 0, F.lit("TORONTO, ON CA")).otherwise(F.col("name")))
    want = fs.clean_observations(obs, tb.ospec).select("STATION_ID", "STATION_LAT", "STATION_LON").distinct()
    got = fs.stations_of(obs, tb.ospec)
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0 and got.count() > 0


def test_weather_by_place_and_clock_is_that_of_the_flights(spark):
    flights, obs, places, *zones = _inputs(spark)
    tb = fs.TestBinding()
    f = fs.prepare_flights(fs.completed_flights(flights, tb.fspec), tb.fspec, places, *zones)
    # the same clocks under other keys, and flights without a clock
    more = f.withColumns({"FLIGHT_IDX": F.col("FLIGHT_IDX") + 1_000_000, "CRS_DEP_UTC": F.when(F.col("FLIGHT_IDX") % 5 != 0, F.col("CRS_DEP_UTC"))})
    f, w = stage(f.unionByName(more)), stage(fs.clean_observations(obs, tb.ospec))
    by_key, by_clock = fs.weather_for_flights(f, w, places), fs.weather_for_flights(f, w, places, key=None, keep=stage)
    assert by_key.columns == by_clock.columns and by_clock.count() == f.count()
    assert by_key.exceptAll(by_clock).count() == 0 and by_clock.exceptAll(by_key).count() == 0
    known = by_clock.where(F.col("WindSpeed").isNotNull())
    assert known.where("FLIGHT_IDX >= 1000000").count() > 0
    clocks = f.select(F.col("ORIGIN").alias("IATA"), "CRS_DEP_UTC").distinct()
    near = fs.near_stations(places, w.select("STATION_ID", "STATION_LAT", "STATION_LON"))
    assert 0 < fs.weather_by_clock(clocks, w, near).count() <= clocks.count() < f.count()


def test_the_result_is_written_without_the_rows_it_drops_and_medians_come_from_clocks(spark, monkeypatch):
    flights, obs, places, *zones = _inputs(spark)
    tb, kept = fs.TestBinding(), []
    monkeypatch.setattr(fs, "stage", lambda df: kept.append(stage(df)) or kept[-1])
    out = fs.feature_table(flights, obs, places, *zones, tb.fspec, tb.ospec)
    wide = [t for t in kept if {"TAIL_NUM", "AIRPORT_ALTITUDE"} <= set(t.columns)]
    # what no later step reads is not written with the prepared flights
    assert not {"DEP_LOCAL", "HOURLY_MINUTE_OF_DELAY", "ORIGIN_STATE_ABR"} & set(wide[0].columns)
    assert wide[1].columns == list(fs.FINAL) and wide[1].count() == out.count() < wide[0].count()
    (clocks,) = [t for t in kept if "FLIGHTS" in t.columns and "WindSpeed" in t.columns]
    assert clocks.agg(F.sum("FLIGHTS")).first()[0] == wide[0].count()
    # several flights of a clock, flights without a clock: the medians count flights, not clocks
    f = wide[0].unionByName(wide[0].where("FLIGHT_IDX % 3 = 0").withColumn("FLIGHT_IDX", -F.col("FLIGHT_IDX")))
    f = stage(f.withColumn("CRS_DEP_UTC", F.when(F.col("FLIGHT_IDX") % 11 != 0, F.col("CRS_DEP_UTC"))))
    w = stage(fs.clean_observations(obs, tb.ospec).where("STATION_ID % 2 = 0 or WindSpeed > 60"))
    near = fs.near_stations(places, w.select("STATION_ID", "STATION_LAT", "STATION_LON"))
    clocks = fs.counted_clocks(f, w, near, keep=stage)
    by_clock = fs.finish(fs.weather_for_flights(f, w, places, near=near, key=None, clocks=clocks), clocks)
    by_flight = fs.finish(fs.weather_for_flights(f, w, places, near=near))
    assert by_clock.exceptAll(by_flight).count() == 0 and by_flight.exceptAll(by_clock).count() == 0 and by_clock.count() > 0


def test_only_wanted_columns_are_carried(spark, monkeypatch):
    flights, obs, places, *zones = _inputs(spark)
    tb, kept = fs.TestBinding(), []
    whole = fs.feature_table(flights, obs, places, *zones, tb.fspec, tb.ospec).select(*sm.COLUMNS)
    monkeypatch.setattr(fs, "stage", lambda df: kept.append(stage(df)) or kept[-1])
    part = fs.feature_table(flights, obs, places, *zones, tb.fspec, tb.ospec, columns=sm.COLUMNS)
    assert part.columns == list(sm.COLUMNS)
    assert part.exceptAll(whole).count() == 0 and whole.exceptAll(part).count() == 0 and part.count() > 0
    assert not any({"DEST_CITY_NAME", "PREV_FLIGHT_IDX", "OP_UNIQUE_CARRIER"} & set(t.columns) for t in kept)


def test_names_are_read_for_the_readings_of_near_stations_only(spark):
    _, obs, *_ = _inputs(spark)
    tb = fs.TestBinding()
    # a station that has a name outside the region on some readings
    obs = stage(obs.withColumn("name", F.when(F.col("WND").startswith("1"), F.lit("TORONTO, ON CA")).otherwise(F.col("name"))))
    regional = stage(fs.regional_stations(obs, tb.ospec).where("station <= 3"))
    got, want = fs.clean_observations(obs, tb.ospec, near=regional), fs.clean_observations(obs, tb.ospec).where("STATION_ID <= 3")
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    assert 0 < got.count() < obs.where("station <= 3").count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in line and "substring_index" in line for line in plan.splitlines()), plan


@pytest.mark.parametrize("query,columns", [
    ("study_roc_curve", sm.COLUMNS),
    ("study_correlation", fs.NUMERIC),
    ("study_fraction_rows", sm.COLUMNS),
    ("study_model", sm.COLUMNS),
    ("study_gradient", sm.COLUMNS),
    ("study_tuned", sm.COLUMNS),
])
def test_queries_carry_only_the_columns_they_read(spark, monkeypatch, query, columns):
    class Asked(Exception):
        pass

    def ask(*_, columns=fs.FINAL, **__):
        raise Asked(columns)

    monkeypatch.setattr(fs, "feature_table", ask)
    with pytest.raises(Asked) as asked:
        QUERIES[query](spark, SF_SMALL)
    assert set(asked.value.args[0]) == set(columns) < set(fs.FINAL)
