"""How the driver's test tables stand in for the study's domain.

``events`` is the flight log: ``user_id`` is the entity (aircraft),
``event_type`` the place (airport), ``ts`` the scheduled clock and
``value`` the delay in minutes; an event is *delayed* when value > 80.
``lineitem`` provides composite observation strings and scored rows;
``nation``/``supplier`` get coordinates from their keys; ``orders`` ->
``customer`` -> ``nation`` gives local clocks with zones.

Each builder returns a DataFrame derived by Spark from the given tables,
so its size grows with them.  ``oracle.py`` holds the same derivations in
SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: delay threshold (minutes) that makes an event "delayed".
DELAY_THRESHOLD = 80


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from aloft.sources.io import read_table
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events + the delayed flag (int 0/1)."""
    ev = table(spark, sf_dir, "events")
    return ev.withColumn("delayed", (F.col("value") > DELAY_THRESHOLD).cast("int"))


def _lp(c, n: int):
    return F.lpad(c.cast("long").cast("string"), n, "0")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw composite weather strings built from lineitem columns.

    Quality code = l_linenumber (1..7, so 2, 3, 6, 7 are bad); sentinels and
    malformed values are planted by key arithmetic.
    """
    li = table(spark, sf_dir, "lineitem")
    pk, sk, ok = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    q = F.col("l_linenumber").cast("string")
    qty = F.col("l_quantity").cast("int")
    angle = F.when(pk % 37 == 0, F.lit(999)).otherwise(pk % 360)
    speed = F.when(sk % 29 == 0, F.lit(9999)).otherwise(qty * 3)
    # every 101st order loses the last part (concat_ws skips the null)
    wnd = F.concat_ws(",", _lp(angle, 3), q, F.lit("N"), _lp(speed, 4), F.when(ok % 101 != 0, q))
    vv = F.when(pk % 31 == 0, F.lit(99999)).otherwise((pk * 7) % 22000)
    cig = F.concat_ws(",", _lp(vv, 5), q, F.lit("M"), F.lit("N"))
    vis = F.when(sk % 23 == 0, F.lit(999999)).otherwise((pk * 13) % 20000)
    vis_s = F.concat_ws(",", _lp(vis, 6), q, F.lit("N"), F.lit("1"))
    t = qty * 7 - 100
    tmp = F.when(pk % 43 == 0, F.lit("+9999")).otherwise(
        F.concat(F.when(t < 0, F.lit("-")).otherwise(F.lit("+")), _lp(F.abs(t), 4)))
    d = qty * 5 - 120
    dew = F.when(sk % 47 == 0, F.lit("+9999")).otherwise(
        F.concat(F.when(d < 0, F.lit("-")).otherwise(F.lit("+")), _lp(F.abs(d), 4)))
    slp = F.when(pk % 41 == 0, F.lit(99999)).otherwise(9900 + pk % 400)
    code = pk % 10
    height = F.when(sk % 19 == 0, F.lit(99999)).otherwise((pk * 11) % 30000)
    gd1 = F.when(ok % 13 == 0, F.lit("")).otherwise(
        F.concat_ws(",", code.cast("string"), F.lit("99"), q, F.concat(F.lit("+"), _lp(height, 5)), q, F.lit("9")))
    aw_code = _lp(pk % 100, 2)
    aw1 = F.when(ok % 3 == 0, F.lit("")).when(ok % 3 == 1, F.lit(None).cast("string")) \
        .otherwise(F.concat_ws(",", aw_code, q))
    aw2 = F.when(sk % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat_ws(",", _lp(sk % 100, 2), q))
    return li.select("l_orderkey", "l_linenumber", "l_suppkey",
                     wnd.alias("WND"), cig.alias("CIG"), vis_s.alias("VIS"),
                     F.concat_ws(",", tmp, q).alias("TMP"),
                     F.concat_ws(",", dew, q).alias("DEW"),
                     F.concat_ws(",", _lp(slp, 5), q).alias("SLP"),
                     gd1.alias("GD1"), aw1.alias("AW1"), aw2.alias("AW2"))


def nation_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations on a 5 x 5 grid with 0.5 degree spacing."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return n.select("n_nationkey", (F.lit(40.0) + (k % 5) * 0.5).alias("lat"),
                    (F.lit(-100.0) + F.floor(k / 5) * 0.5).alias("lon"))


def supplier_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers on a 10 x 10 grid with 0.23 x 0.24 degree spacing, offset from the nations."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select("s_suppkey", (F.lit(40.01) + (k % 10) * 0.23).alias("lat"),
                    (F.lit(-100.02) + F.floor(k / 10) % 10 * 0.24).alias("lon"))


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with a label (return flag R), an arithmetic score and a hard prediction."""
    li = table(spark, sf_dir, "lineitem")
    score = F.round(F.col("l_discount") * 5 + F.col("l_tax") * 3 + F.col("l_quantity") / 100, 4)
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_returnflag") == "R").cast("int").alias("label"),
                     score.alias("score")).withColumn("prediction", (F.col("score") > 0.6).cast("int"))


# ---------------------------------------------------------------- the end-to-end study on test tables
# Zones of the five synthetic states of the study binding.
STUDY_STATE_ZONES = [("S00", "America/New_York"), ("S01", "America/Chicago"), ("S02", "America/Denver"),
                     ("S03", "America/Los_Angeles"), ("S04", "America/Anchorage")]


def _md5_index(col: str, modulus: int):
    return F.pmod(F.conv(F.substring(F.md5(F.col(col).cast("string")), 1, 6), 16, 10).cast("long"), F.lit(modulus))


# A city whose zone goes before its state's.
STUDY_CITY_ZONES = [("City error", "Pacific/Guam")]


def _hhmm(t):
    """The hhmm text of a clock; midnight is written 2400."""
    c = F.hour(t) * 100 + F.minute(t)
    return F.lpad(F.when(c == 0, 2400).otherwise(c).cast("string"), 4, "0")


def study_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as raw on-time records: dates in parts, clocks as hhmm text, some cancelled, some without a tail number."""
    ev = table(spark, sf_dir, "events")
    i, late = F.col("event_id"), F.floor("value")
    ahead = lambda m: F.timestamp_add("MINUTE", m, F.col("ts"))
    elapsed = 10 + F.pmod(i * 7, F.lit(150))
    dep, arr = (late - 20).cast("double"), (late * 2 - 85 - F.pmod(i, F.lit(9))).cast("double")
    hour = F.lpad(F.hour("ts").cast("string"), 2, "0")
    return ev.select(
        i.alias("FLIGHT_IDX"), F.year("ts").alias("YEAR"), F.quarter("ts").alias("QUARTER"), F.month("ts").alias("MONTH"),
        F.dayofmonth("ts").alias("DAY_OF_MONTH"), (F.weekday("ts") + 1).alias("DAY_OF_WEEK"), F.to_date("ts").cast("string").alias("FL_DATE"),
        F.concat(F.lit("C"), F.pmod(F.col("user_id"), F.lit(7)).cast("string")).alias("OP_UNIQUE_CARRIER"),
        F.when(i % 40 != 0, F.concat(F.lit("N"), F.col("user_id").cast("string"))).alias("TAIL_NUM"),
        F.col("event_type").alias("ORIGIN"), F.concat(F.lit("City "), F.col("event_type")).alias("ORIGIN_CITY_NAME"),
        F.concat(F.lit("S0"), _md5_index("event_type", 5).cast("string")).alias("ORIGIN_STATE_ABR"),
        F.concat(F.lit("D"), (i % 5).cast("string")).alias("DEST"), F.concat(F.lit("Town "), (i % 5).cast("string")).alias("DEST_CITY_NAME"),
        _hhmm("ts").alias("CRS_DEP_TIME"), F.when(i % 37 != 0, _hhmm(ahead(late - 20))).alias("DEP_TIME"),
        _hhmm(ahead(elapsed)).alias("CRS_ARR_TIME"), _hhmm(ahead(elapsed + late)).alias("ARR_TIME"),
        F.when(i % 41 != 0, dep).alias("DEP_DELAY"), F.greatest(dep, F.lit(0.0)).alias("DEP_DELAY_NEW"), (dep >= 60).cast("int").alias("DEP_DEL15"),
        F.concat(hour, F.lit("00-"), hour, F.lit("59")).alias("DEP_TIME_BLK"), elapsed.cast("double").alias("CRS_ELAPSED_TIME"),
        arr.alias("ARR_DELAY"), F.greatest(arr, F.lit(0.0)).alias("ARR_DELAY_NEW"), F.when(i % 43 != 0, (arr >= 60).cast("int")).alias("ARR_DEL15"),
        F.when(i % 30 == 0, 1.0).otherwise(0.0).alias("CANCELLED"))


def study_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct places as text records with a position a few km from a station of the supplier grid; one has no position, one no altitude."""
    p = table(spark, sf_dir, "events").select(F.col("event_type").alias("IATA")).distinct()
    lat = (F.lit(40.06) + _md5_index("IATA", 10) * 0.23).cast("string")
    return p.select("IATA", F.when(F.col("IATA") == "signup", "unknown").otherwise(lat).alias("Latitude"), F.lit("-99.97").alias("Longitude"),
                    F.when(F.col("IATA") == "error", "none").otherwise("120").alias("Altitude"))


def study_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem rows as station readings: station = supplier (its grid position and a
    'NAME, ST US' label), reading clock inside the events' month (UTC)."""
    obs = observations(spark, sf_dir)
    k = F.col("l_suppkey")
    minutes = F.pmod(F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11, F.lit(43200))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return obs.select(
        k.alias("station"),
        F.concat(F.lit("ST"), k.cast("string"), F.lit(", S0"), F.pmod(k, F.lit(5)).cast("string"), F.lit(" US")).alias("name"),
        (F.lit(40.01) + (k % 10) * 0.23).alias("lat"),
        (F.lit(-100.02) + F.floor(k / 10) % 10 * 0.24).alias("lon"),
        F.timestamp_add("MINUTE", minutes, start).alias("reading_ts"),
        "WND", "CIG", "VIS", "TMP", "DEW", "SLP", "GD1", "AW1", "AW2")


def study_state_tz(spark: SparkSession) -> DataFrame:
    from aloft.sources.io import dim_table
    return dim_table(spark, STUDY_STATE_ZONES, "state string, state_tz string")


def study_city_tz(spark: SparkSession) -> DataFrame:
    from aloft.sources.io import dim_table
    return dim_table(spark, STUDY_CITY_ZONES, "tt_city string, tt_tz string")
