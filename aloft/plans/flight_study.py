"""The study's ETL, end to end, as one plan over the public on-time and station records.

flights: completed filter -> four local clocks from hhmm -> hourly traffic of
all completed flights -> previous flight of the aircraft, ground time ->
lagged traffic attached -> place position, zone, UTC clock.
observations: region filter -> station name/state -> decoded fields.
join: nearest stations per place -> readings in (t-3h, t-2h) at those
stations -> means and modes per flight -> attached back (left).
finish: grouped median imputation by (place, day block) -> indicators ->
fill, drop and trim -> the final column list.

Flights carry the column names of the public on-time records; ``ObsSpec`` maps
the station records.  The stages are materialised with ``sources.io.stage``
(shared folder) to cut lineage on long runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.functions import clock, decode, flags
from aloft.operators import clean, enrich, interval, nearest, sequence, summarize, traffic
from aloft.sources.io import stage, stage_bucketed


@dataclass(frozen=True)
class FlightSpec:
    """Choices of the flight side; the columns are those of the public on-time records."""
    key: str = "FLIGHT_IDX"             # unique per row (``clean.with_row_key`` where the records have none)
    completed: str = "CANCELLED == 0 AND DEP_TIME IS NOT NULL AND ARR_TIME IS NOT NULL"
    order: tuple[str, ...] = ("CRS_DEP_LOCAL", "DEP_LOCAL", "CRS_ARR_LOCAL", "ARR_LOCAL")
    ties: str = "one"
    rollover: str = "next_day"          # what 2400 means: see ``clock.hhmm_to_ts``
    delay_scale: int | None = None      # decimals of the delays (exact hourly means when set)


@dataclass(frozen=True)
class ObsSpec:
    station: str = "STATION"
    ts: str = "DATE"                    # UTC clock of the reading
    lat: str = "LATITUDE"
    lon: str = "LONGITUDE"
    name: str = "NAME"
    condition_cols: tuple[str, ...] = ("AW1", "AW2", "AW3", "AW4", "AW5", "AW6", "AW7")
    measure_scale: int | None = 1       # decoded measures have at most 1 decimal: exact, order-free means


# Study parameters.
NEAREST_K = 3
NEAREST_MAX_KM = 30.0
WINDOW_LO, WINDOW_HI = "-3 hours", "-2 hours"
BIN = "READING_BIN"                             # hours of the readings, stored to bucket the weather
TRAFFIC_LAG = "2 hours"
NUMERIC_WEATHER = ("WindAngle", "WindSpeed", "VerticalVisibility", "Visibility", "Temperature",
                   "DewPointTemp", "SeaLevelPressure", "CloudHeight")
MODE_WEATHER = ("CloudMode", "AtmCondition")
IMPUTED = ("WindSpeed", "VerticalVisibility", "Visibility", "Temperature", "DewPointTemp", "CloudHeight")
# Hhmm clocks and the local timestamps made of them.
CLOCKS = {"CRS_DEP_TIME": "CRS_DEP_LOCAL", "DEP_TIME": "DEP_LOCAL", "CRS_ARR_TIME": "CRS_ARR_LOCAL", "ARR_TIME": "ARR_LOCAL"}
# Columns kept of a flight, and those carried over from the aircraft's previous flight.
FLIGHT_COLUMNS = ("FLIGHT_IDX", "QUARTER", "MONTH", "DAY_OF_WEEK", "FL_DATE", "CRS_DEP_TIME", "DEP_TIME_BLK", "OP_UNIQUE_CARRIER",
                  "TAIL_NUM", "ORIGIN", "ORIGIN_CITY_NAME", "ORIGIN_STATE_ABR", "DEST", "DEST_CITY_NAME", "CRS_ELAPSED_TIME",
                  "DEP_DELAY", "DEP_DELAY_NEW", "DEP_DEL15", "ARR_DELAY", "ARR_DELAY_NEW", "ARR_DEL15")
CARRIED = ("FLIGHT_IDX", "CRS_DEP_LOCAL", "DEP_LOCAL", "DEP_DELAY", "DEP_DELAY_NEW", "DEP_DEL15", "CRS_ELAPSED_TIME",
           "CRS_ARR_LOCAL", "ARR_LOCAL", "ARR_DELAY", "ARR_DELAY_NEW", "ARR_DEL15")
# What the ground time needs of the previous flight.
GROUND = ("DEP_LOCAL", "CRS_ELAPSED_TIME")
# Columns of the completed flights that the joins, the traffic and the ground time read.
USED = ("FLIGHT_IDX", "TAIL_NUM", "ORIGIN", "ORIGIN_STATE_ABR", "ORIGIN_CITY_NAME", "CRS_DEP_LOCAL", "DEP_DEL15", "DEP_DELAY", "DEP_DELAY_NEW")
# Departure-time blocks turned into indicators.
BLOCK_FLAGS = {"BLOCK6": "0600-0659", "BLOCK7": "0700-0759", "BLOCK0": "0001-0559", "BLOCK8": "0800-0859"}
# The final columns, required columns and open-range trims of the final table.
FINAL = ("FLIGHT_IDX", "QUARTER", "MONTH", "DAY_OF_WEEK", "FL_DATE", "CRS_DEP_TIME", "DEP_TIME_BLK", "CRS_DEP_UTC", "OP_UNIQUE_CARRIER",
         "TAIL_NUM", "ORIGIN", "ORIGIN_CITY_NAME", "ORIGIN_TIMEZONE", "AIRPORT_LATITUDE", "AIRPORT_LONGITUDE", "AIRPORT_ALTITUDE",
         "DEST", "DEST_CITY_NAME", "CRS_ELAPSED_TIME", "DEP_DELAY", "DEP_DELAY_NEW", "DEP_DEL15", "PREV_DEP_TO_CURR_CRSDEP", "PREP_TIME",
         "HOURLY_DELAY_RATE", "HOURLY_NUM_OF_FLIGHTS", "HOURLY_NUM_OF_DELAY", *[f"PREV_{c}" for c in CARRIED],
         "WindAngle", "WindSpeed_imp", "VerticalVisibility_imp", "Visibility_imp", "Temperature_imp", "DewPointTemp_imp",
         "SeaLevelPressure", "CloudHeight_imp", "CloudMode", "AtmCondition", "CloudMode_binary", *BLOCK_FLAGS)
# those of FINAL that are numbers
NUMERIC = tuple(c for c in FINAL if c not in {
    "FL_DATE", "CRS_DEP_TIME", "DEP_TIME_BLK", "CRS_DEP_UTC", "OP_UNIQUE_CARRIER", "TAIL_NUM", "ORIGIN", "ORIGIN_CITY_NAME", "ORIGIN_TIMEZONE",
    "DEST", "DEST_CITY_NAME", "PREV_CRS_DEP_LOCAL", "PREV_DEP_LOCAL", "PREV_CRS_ARR_LOCAL", "PREV_ARR_LOCAL"})
DROP_IF_NULL = ("ORIGIN", "FL_DATE", "MONTH", "DAY_OF_WEEK", "DEP_TIME_BLK", "AIRPORT_ALTITUDE", "PREP_TIME", "HOURLY_DELAY_RATE",
                "HOURLY_NUM_OF_FLIGHTS", "PREV_DEP_DEL15", "PREV_CRS_ELAPSED_TIME", "PREV_ARR_DEL15", "WindSpeed_imp",
                "VerticalVisibility_imp", "Visibility_imp", "Temperature_imp", "DewPointTemp_imp", "DEP_DELAY_NEW", "DEP_DEL15")
TRIMS = {"PREV_CRS_ELAPSED_TIME": (18, None), "CRS_ELAPSED_TIME": (18, None), "PREV_DEP_DELAY": (-45, 1609),
         "PREV_ARR_DELAY": (-81, 1605), "DEP_DELAY": (-45, 1609)}


def completed_flights(flights: DataFrame, s: FlightSpec = FlightSpec()) -> DataFrame:
    """Completed flights with their local clocks."""
    f = clean.completed_events(flights, s.completed).withColumn("FLIGHT_IDX", F.col(s.key))
    # one lambda for the four clocks: written out four times they make a method too long for the JIT
    local = F.transform(F.array(*[F.col(c).cast("string") for c in CLOCKS]),
                        lambda hhmm: clock.hhmm_to_ts(F.col("YEAR"), F.col("MONTH"), F.col("DAY_OF_MONTH"), hhmm, s.rollover))
    f = f.select(*FLIGHT_COLUMNS, local.alias("__local"))
    return f.withColumns({ts: F.get("__local", F.lit(i)) for i, ts in enumerate(CLOCKS.values())}).drop("__local")


def prepare_flights(done: DataFrame, s: FlightSpec, places: DataFrame, state_tz: DataFrame,
                    city_tz: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] = lambda df: df,
                    carried: Sequence[str] = CARRIED) -> DataFrame:
    """Completed flights with predecessor, ground time, lagged traffic, place position and UTC clock.

    The traffic counts all completed flights, those without a predecessor or a tail number too.
    ``places``: IATA, Latitude, Longitude, Altitude (text or numbers).  ``keep`` (``stage``) writes the tables looked up, so
    that the planner knows their size and does not shuffle the flights for a small one.  An aircraft is split by days:
    by hours nearly every flight is a segment of its own, and the table of segments is as large as the flights.
    ``carried``: what is wanted of the previous flight, ``GROUND`` at least."""
    f = sequence.with_previous(done, "TAIL_NUM", list(s.order), list(carried), prefix="PREV_", ties=s.ties,
                               tie_break=["FLIGHT_IDX"] if s.ties == "one" else None, split="day")
    gap = clock.minutes_between("CRS_DEP_LOCAL", "PREV_DEP_LOCAL")
    f = f.withColumn("PREV_DEP_TO_CURR_CRSDEP", gap).withColumn("PREP_TIME", gap - F.col("PREV_CRS_ELAPSED_TIME"))
    f = traffic.with_lagged_rate(f, "ORIGIN", "CRS_DEP_LOCAL", "DEP_DEL15",
                                 {"DEP_DELAY": "HOURLY_MINUTE_OF_DELAY", "DEP_DELAY_NEW": "HOURLY_MINUTE_OF_DELAY_NEW"},
                                 lag=TRAFFIC_LAG, count_name="HOURLY_NUM_OF_FLIGHTS", flagged_name="HOURLY_NUM_OF_DELAY",
                                 rate_name="HOURLY_DELAY_RATE", scale=s.delay_scale, of=done, keep=keep)
    where = places.select(F.col("IATA").alias("ORIGIN"), F.col("Latitude").try_cast("double").alias("AIRPORT_LATITUDE"),
                          F.col("Longitude").try_cast("double").alias("AIRPORT_LONGITUDE"),
                          F.col("Altitude").try_cast("double").alias("AIRPORT_ALTITUDE"))
    f = enrich.lookup(f, keep(where), "ORIGIN", "inner")
    f = enrich.attach_timezone(f, "ORIGIN_STATE_ABR", "ORIGIN_CITY_NAME", state_tz, city_tz, out="ORIGIN_TIMEZONE")
    return enrich.with_utc(f, "CRS_DEP_LOCAL", "ORIGIN_TIMEZONE", "CRS_DEP_UTC")


def clean_observations(obs: DataFrame, s: ObsSpec, countries: Sequence[str] = decode.DEFAULT_COUNTRIES,
                       strict_parity: bool = False, near: DataFrame | None = None) -> DataFrame:
    """Region filter, station name/state, decoded fields with sentinels removed.

    ``near``: the rows of ``regional_stations`` wanted.  Readings of other stations leave by the station, before a name is looked
    at, and the names of the rest are matched: a region filter on the readings would be moved in front of these joins."""
    if near is None:
        o = obs.where(decode.region_predicate(s.name, countries))
    else:
        o = obs.join(near.select(s.station), s.station, "left_semi").join(near.select(s.station, s.name), [s.station, s.name], "left_semi")
    o = o.withColumns(decode.station_name_state(s.name))
    present = [c for c in s.condition_cols if c in o.columns]
    o = o.withColumn("AW", decode.first_nonempty(present, skip_empty=not strict_parity))
    o = decode.decode_observations(o, strict_parity=strict_parity)
    return o.select(F.col(s.station).alias("STATION_ID"), "StationName", "State",
                    F.col(s.lat).try_cast("double").alias("STATION_LAT"), F.col(s.lon).try_cast("double").alias("STATION_LON"),
                    F.col(s.ts).alias("READING_TS"), *NUMERIC_WEATHER, *MODE_WEATHER)


def regional_stations(obs: DataFrame, s: ObsSpec, countries: Sequence[str] = decode.DEFAULT_COUNTRIES) -> DataFrame:
    """The stations, names and positions that ``clean_observations`` keeps; the region filter runs once for each, not per reading."""
    return obs.select(s.station, s.name, s.lat, s.lon).distinct().where(decode.region_predicate(s.name, countries))


def stations_of(obs: DataFrame, s: ObsSpec, countries: Sequence[str] = decode.DEFAULT_COUNTRIES, regional: DataFrame | None = None) -> DataFrame:
    """The positions of the ``regional_stations``."""
    o = regional_stations(obs, s, countries) if regional is None else regional
    return o.select(F.col(s.station).alias("STATION_ID"), F.col(s.lat).try_cast("double").alias("STATION_LAT"),
                    F.col(s.lon).try_cast("double").alias("STATION_LON"))


def near_stations(places: DataFrame, stations: DataFrame) -> DataFrame:
    """(IATA, STATION_ID): the <= 3 nearest stations of each place."""
    return nearest.nearest_k(places, stations, "IATA", "Latitude", "Longitude", "STATION_ID", "STATION_LAT", "STATION_LON",
                             k=NEAREST_K, max_km=NEAREST_MAX_KM).select("IATA", "STATION_ID")


def weather_by_clock(clocks: DataFrame, weather: DataFrame, near: DataFrame, measure_scale: int | None = 1) -> DataFrame:
    """Readings of a place's near stations in the window before each (IATA, CRS_DEP_UTC), summarised; clocks without any are left out."""
    at = clocks.join(near, "IATA", "inner")
    bins = [BIN] if BIN in weather.columns else []
    readings = weather.select(F.col("STATION_ID").alias("R_STATION"), "READING_TS", *bins, *NUMERIC_WEATHER, *MODE_WEATHER)
    m = interval.interval_join(at, readings, "STATION_ID", "R_STATION", "CRS_DEP_UTC", "READING_TS",
                               lo=WINDOW_LO, hi=WINDOW_HI, right_bin=BIN if bins else None)
    return summarize.summarize(m, ["IATA", "CRS_DEP_UTC"], means=list(NUMERIC_WEATHER), modes=list(MODE_WEATHER), scale=measure_scale)


def counted_clocks(flights: DataFrame, weather: DataFrame, near: DataFrame, measure_scale: int | None = 1,
                   keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(ORIGIN, CRS_DEP_UTC, FLIGHTS, weather): the clocks of each place with the number of their flights, those without readings or clock too."""
    at = ["ORIGIN", "CRS_DEP_UTC"]
    clocks = keep(flights.groupBy(*at).agg(F.count(F.lit(1)).alias("FLIGHTS")))
    known = weather_by_clock(clocks.select(F.col("ORIGIN").alias("IATA"), "CRS_DEP_UTC"), weather, near, measure_scale)
    return keep(clocks.join(known.withColumnRenamed("IATA", "ORIGIN"), at, "left"))


def weather_for_flights(flights: DataFrame, weather: DataFrame, places: DataFrame, measure_scale: int | None = 1,
                        near: DataFrame | None = None, key: str | None = "FLIGHT_IDX",
                        keep: Callable[[DataFrame], DataFrame] = lambda df: df, clocks: DataFrame | None = None) -> DataFrame:
    """Readings of the <= 3 nearest stations in the window before each flight, summarised per flight.

    The summary is a function of the place and the clock, so it is made once for each of these and attached to
    the flights: through ``key`` (``flights`` bucketed on it are read without an exchange) or, with None, by place and clock.
    ``weather`` bucketed on (STATION_ID, READING_BIN) is read without an exchange; without READING_BIN it gets its bins here.
    ``near``: the stations of each place, where they are known already.  ``keep``: as in ``prepare_flights``.
    ``clocks``: the flights' ``counted_clocks``, where they are made already."""
    at = ["ORIGIN", "CRS_DEP_UTC"]
    if clocks is None:
        near = near_stations(places, weather.select("STATION_ID", "STATION_LAT", "STATION_LON")) if near is None else near
        distinct = flights.select(*at).distinct().withColumnRenamed("ORIGIN", "IATA")
        per = keep(weather_by_clock(distinct, weather, near, measure_scale).withColumnRenamed("IATA", "ORIGIN"))
    else:
        per = clocks.select(*at, *NUMERIC_WEATHER, *MODE_WEATHER)
    if key is not None:
        per = flights.select(key, *at).join(per, at, "inner").drop(*at)
    return summarize.attach(flights, per, at if key is None else key).select(*flights.columns, *NUMERIC_WEATHER, *MODE_WEATHER)


def finish(df: DataFrame, clocks: DataFrame | None = None, columns: Sequence[str] = FINAL) -> DataFrame:
    """Impute by (place, day block of UTC - 2.5 h), indicators, fill, drop, trim; the final columns.

    The weather and the group are functions of the place and the clock: with ``clocks`` (``counted_clocks`` of the same
    flights) the medians come from these, each counting as often as it has flights."""
    block = clock.day_block("CRS_DEP_UTC", "-150 minutes")
    counted = None if clocks is None else clocks.withColumn("WEATHER_BLOCK", block)
    d = df.withColumn("WEATHER_BLOCK", block)
    d = summarize.impute_by_group(d, ["ORIGIN", "WEATHER_BLOCK"], list(IMPUTED), counted=counted, weight=None if counted is None else "FLIGHTS")
    d = d.withColumns({"CloudMode_binary": flags.flag_equals("CloudMode", 0),
                       **{k: flags.flag_equals("DEP_TIME_BLK", v) for k, v in BLOCK_FLAGS.items()}})
    d = clean.fill_null(_only(d, {*columns, *DROP_IF_NULL, *TRIMS}), 0, ["HOURLY_DELAY_RATE", "HOURLY_NUM_OF_FLIGHTS"])
    d = clean.drop_null(d, list(DROP_IF_NULL))
    return clean.between_open(d, TRIMS).select(*columns)


def _only(df: DataFrame, names: set[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c in names])


def feature_table(flights: DataFrame, obs: DataFrame, places: DataFrame, state_tz: DataFrame,
                  city_tz: DataFrame | None = None, fspec: FlightSpec = FlightSpec(),
                  ospec: ObsSpec = ObsSpec(), stages: bool = True, columns: Sequence[str] = FINAL) -> DataFrame:
    """The whole ETL: one row per kept flight with ``columns`` (all of ``FINAL``, or the ones wanted: others are not carried along).

    Completed flights and prepared flights are each read by two or more later steps and the result by as many as the caller
    has, so they are written as Parquet under the shared
    checkpoint folder and read again (a lost executor re-reads instead of
    recomputing; pruning and pushdown still apply); ``stages=False`` keeps one lazy plan.
    The weather is attached and the gaps are filled in one pass, in which the rows that are dropped leave before they are written.
    Tables that wide ones are joined with are written too: their size is then known to the planner.
    The near stations are found first, so only readings that a place can use are decoded and moved; these
    are bucketed on the keys of the join that follows.
    """
    keep = stage if stages else (lambda df: df)
    bucketed = stage_bucketed if stages else (lambda df, keys: df)
    wanted = {*columns, *DROP_IF_NULL, *TRIMS, "ORIGIN", "CRS_DEP_UTC"}
    carried = [c for c in CARRIED if c in GROUND or f"PREV_{c}" in wanted]
    done = keep(_only(completed_flights(flights, fspec), {*wanted, *USED, *fspec.order, *carried}))
    f = keep(_only(prepare_flights(done, fspec, places, state_tz, city_tz, keep, carried), wanted))
    regional = keep(regional_stations(obs, ospec))
    near = keep(near_stations(places, stations_of(obs, ospec, regional=regional)))
    named = keep(regional.join(near.select(F.col("STATION_ID").alias(ospec.station)), ospec.station, "left_semi"))
    w = bucketed(clean_observations(obs, ospec, near=named).withColumn(BIN, interval.bin_of("READING_TS")), ["STATION_ID", BIN])
    clocks = counted_clocks(f, w, near, ospec.measure_scale, keep)
    j = weather_for_flights(f, w, places, ospec.measure_scale, near, key=None, clocks=clocks)
    return keep(finish(j, clocks, columns))


@dataclass(frozen=True)
class TestBinding:
    """How the driver's tables play flights, stations and places (see ``bindings``)."""
    fspec: FlightSpec = field(default_factory=lambda: FlightSpec(delay_scale=0))
    ospec: ObsSpec = field(default_factory=lambda: ObsSpec(
        station="station", ts="reading_ts", lat="lat", lon="lon", name="name", condition_cols=("AW1", "AW2")))
