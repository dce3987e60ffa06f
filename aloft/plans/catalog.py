"""Registered queries: one per operator family of the study, on the driver's test tables.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
whole tables.  Column names equal those of the SQL oracle in
``aloft.plans.oracle``; doubles that depend on summation order are
rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.functions import clock, decode, flags, stats
from aloft.operators import clean, enrich, evaluate, features, interval, nearest, profile, sequence, \
    summarize, traffic
from aloft.plans import bindings as b
from aloft.session import scratch_path
from aloft.sources import io

Query = Callable[[SparkSession, str], DataFrame]
R = 6  # decimals kept for order-dependent doubles


def _r(c, d: int = R):
    return stats.round_half_up(c, d)


# A literal region -> zone table (region 4 deliberately absent)
# and name overrides, standing in for the state and territory zone tables.
REGION_ZONES = [(0, "America/New_York"), (1, "Europe/Berlin"), (2, "Asia/Tokyo"), (3, "Australia/Sydney")]
NAME_ZONES = [("NATION_4", "Pacific/Guam"), ("NATION_9", "Pacific/Saipan"), ("NATION_14", "Pacific/Pago_Pago")]


# ---------------------------------------------------------------- scans, projections, nulls
def scan_project_filter(spark, sf):
    li = b.table(spark, sf, "lineitem")
    kept = clean.completed_events(li, "l_linestatus == 'F' AND l_shipdate IS NOT NULL AND l_discount IS NOT NULL")
    return kept.selectExpr("l_orderkey AS order_key", "l_linenumber AS line", "l_quantity AS qty",
                           "l_extendedprice * (1 - l_discount) AS net_price", "l_shipdate AS ship_ts") \
        .where(F.col("qty").isNotNull())


def csv_named_roundtrip(spark, sf):
    from aloft.session import scratch_path
    path = scratch_path(spark, "nation-csv")
    io.write_table(b.table(spark, sf, "nation"), path, fmt="csv", header="false")
    raw = io.read_csv_named(spark, path, ["c0", "c1", "c2"]).toDF("n_nationkey", "n_name", "n_regionkey")
    return raw.select(F.col("n_nationkey").try_cast("int").alias("n_nationkey"), "n_name",
                      F.col("n_regionkey").try_cast("int").alias("n_regionkey"))


def _zones(spark):
    state = io.dim_table(spark, REGION_ZONES, "state int, state_tz string")
    city = io.dim_table(spark, NAME_ZONES, "tt_city string, tt_tz string")
    return state, city


def literal_dimension(spark, sf):
    state, city = _zones(spark)
    n = b.table(spark, sf, "nation")
    return enrich.attach_timezone(n, "n_regionkey", "n_name", state, city, out="tz") \
        .select("n_nationkey", "n_name", "tz")


def stable_row_key(spark, sf):
    # business columns with nulls that repeat: equal rows get numbered keys
    li = b.table(spark, sf, "lineitem").select("l_suppkey", F.nullif(F.col("l_linenumber"), F.lit(3)).alias("line"),
                                               F.nullif("l_returnflag", F.lit("A")).alias("flag"), "l_linestatus")
    return clean.with_row_key(li, "row_key", ["l_suppkey", "line", "flag", "l_linestatus"], unique=True)


def sentinel_to_null(spark, sf):
    li = b.table(spark, sf, "lineitem")
    out = clean.null_if(li, {"l_discount": 0.0, "l_tax": 0.0})
    band = F.when(F.col("l_discount").isNull(), F.lit("none")) \
        .when(F.col("l_discount") >= 0.05, F.lit("high")).otherwise(F.lit("low"))
    return out.select("l_orderkey", "l_linenumber", F.col("l_discount").alias("discount"),
                      F.col("l_tax").alias("tax"), band.alias("disc_band"))


def fill_then_drop_null(spark, sf):
    ev = b.flights(spark, sf)
    lag = traffic.with_lagged_rate(ev, "event_type", "ts", "delayed", lag="2 hours",
                                   count_name="hourly_n", flagged_name="hourly_delayed", rate_name="hourly_rate")
    lag = clean.fill_null(lag, 0, ["hourly_n", "hourly_rate"])
    prev = sequence.with_previous(lag, "user_id", ["ts"], ["value"], prefix="prev_", keep_first=True,
                                  tie_break=["event_id"])
    out = clean.drop_null(prev, ["prev_value", "hourly_rate", "hourly_delayed"])
    return out.select("event_id", "hourly_n", _r("hourly_rate").alias("hourly_rate"), "prev_value")


def outlier_trim(spark, sf):
    ev = b.table(spark, sf, "events")
    return clean.between_open(ev, {"value": (5, 450), "user_id": (0, None)}).select("event_id", "value")


def region_filter(spark, sf):
    c = b.table(spark, sf, "customer")
    k = F.col("c_nationkey")
    country = F.element_at(F.array(*[F.lit(x) for x in ("US", "GQ", "AQ", "CA", "MX")]), (k % 5 + 1).cast("int"))
    state = F.concat(F.lit("S"), F.lpad(k.cast("string"), 2, "0"))
    name = F.when(F.col("c_custkey") % 7 == 0, F.concat_ws(", ", "c_name", F.lit("X"), F.concat_ws(" ", state, country))) \
        .when(F.col("c_custkey") % 11 == 0, F.concat(F.col("c_name"), F.lit(", "), state, F.lit(" "), country, F.lit(" Z"))) \
        .otherwise(F.concat(F.col("c_name"), F.lit(", "), state, F.lit(" "), country))
    src = c.select("c_custkey", name.alias("NAME"))
    kept = src.where(decode.region_predicate("NAME"))
    return kept.withColumns(decode.station_name_state("NAME")).select("c_custkey", "StationName", "State")


# ---------------------------------------------------------------- decoders
def _decoded(spark, sf, names, skip_empty=True):
    obs = b.observations(spark, sf).withColumn("AW", decode.first_nonempty(["AW1", "AW2"], skip_empty))
    specs = [decode.field_spec(n) for n in names]
    return decode.decode_observations(obs, specs).select("l_orderkey", "l_linenumber", *names)


def decode_wind(spark, sf):
    return _decoded(spark, sf, ["WindAngle", "WindSpeed"])


def decode_ceiling(spark, sf):
    return _decoded(spark, sf, ["VerticalVisibility"])


def decode_visibility(spark, sf):
    return _decoded(spark, sf, ["Visibility"])


def decode_temperature(spark, sf):
    return _decoded(spark, sf, ["Temperature"])


def decode_dew(spark, sf):
    return _decoded(spark, sf, ["DewPointTemp"])


def decode_pressure(spark, sf):
    return _decoded(spark, sf, ["SeaLevelPressure"])


def decode_cloud(spark, sf):
    return _decoded(spark, sf, ["CloudMode", "CloudHeight"])


def decode_condition(spark, sf):
    return _decoded(spark, sf, ["AtmCondition"])


def decode_reject_report(spark, sf):
    obs = b.observations(spark, sf).withColumn("AW", decode.first_nonempty(["AW1", "AW2"]))
    return decode.reject_report(obs)


# ---------------------------------------------------------------- clocks
def hhmm_clock(spark, sf):
    li = b.table(spark, sf, "lineitem")
    hhmm = F.when(F.col("l_linenumber") == 7, F.lit(2400)) \
        .otherwise((F.col("l_quantity").cast("int") % 24) * 100 + F.col("l_partkey") % 60)
    d = li.select("l_orderkey", "l_linenumber", hhmm.cast("int").alias("hhmm"), "l_shipdate")
    y, m, dd = F.year("l_shipdate"), F.month("l_shipdate"), F.dayofmonth("l_shipdate")
    return d.select("l_orderkey", "l_linenumber", "hhmm",
                    clock.hhmm_to_ts(y, m, dd, "hhmm").alias("ts_next_day"),
                    clock.hhmm_to_ts(y, m, dd, "hhmm", rollover="same_day").alias("ts_same_day"))


def clock_shift_bucket(spark, sf):
    ev = b.table(spark, sf, "events")
    plus2 = clock.shift("ts", "2 hours")
    return ev.select("event_id", plus2.alias("ts_plus2"), clock.hour_label("ts").alias("hour_label"),
                     clock.hour_label(plus2).alias("hour_label_plus2"),
                     clock.hour_start("ts").alias("hour_start"))


def _gaps(spark, sf, wrap):
    ev = b.table(spark, sf, "events")
    p = sequence.with_previous(ev, "user_id", ["ts"], ["event_id", "ts", "value"], prefix="prev_",
                               tie_break=["event_id"])
    prev_actual = F.timestamp_add("SECOND", F.floor(F.col("prev_value") * 60), F.col("prev_ts"))
    gap = clock.minutes_between("ts", prev_actual, wrap_day=wrap)
    return p.select("event_id", "prev_event_id", gap.alias("gap_min"),
                    (gap - F.col("prev_value")).alias("prep_min"))


def minutes_signed(spark, sf):
    return _gaps(spark, sf, False)


def minutes_wrapped(spark, sf):
    return _gaps(spark, sf, True)


def local_to_utc(spark, sf):
    state, city = _zones(spark)
    o = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = b.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    oc = enrich.lookup(enrich.lookup(o, c, "o_custkey", "inner"), n, "c_nationkey", "inner")
    z = enrich.attach_timezone(oc, "n_regionkey", "n_name", state, city, out="tz")
    return enrich.with_utc(z, "o_orderdate", "tz", "utc_ts").select("o_orderkey", "tz", "o_orderdate", "utc_ts")


def day_block(spark, sf):
    ev = b.table(spark, sf, "events")
    return ev.select("event_id", clock.day_block("ts", "-150 minutes").alias("block"))


def indicator_flags(spark, sf):
    o = b.table(spark, sf, "orders")
    mode = F.nullif(F.col("o_custkey") % 5, F.lit(4))
    return o.select("o_orderkey",
                    flags.flag_equals("o_orderpriority", "1-URGENT").alias("f_urgent"),
                    flags.flag_equals("o_orderpriority", "2-HIGH").alias("f_high"),
                    flags.flag_equals("o_orderpriority", "5-LOW").alias("f_low"),
                    flags.flag_equals(mode, 0).alias("f_zero"))


# ---------------------------------------------------------------- geo
def haversine_pairs(spark, sf):
    p = nearest.pairs_within(b.nation_points(spark, sf), b.supplier_points(spark, sf),
                             "n_nationkey", "lat", "lon", "s_suppkey", "lat", "lon", max_km=60.0)
    return p.select("n_nationkey", "s_suppkey", _r("distance_km").alias("distance_km"))


def dense_pairs(spark, sf):
    """As haversine_pairs, with cells that are split from nine sites on."""
    p = nearest.pairs_within(b.nation_points(spark, sf), b.supplier_points(spark, sf), "n_nationkey", "lat", "lon",
                             "s_suppkey", "lat", "lon", max_km=60.0, max_sites=8)
    return p.select("n_nationkey", "s_suppkey", _r("distance_km").alias("distance_km"))


def nearest_three(spark, sf):
    p = nearest.nearest_k(b.nation_points(spark, sf), b.supplier_points(spark, sf),
                          "n_nationkey", "lat", "lon", "s_suppkey", "lat", "lon", k=3, max_km=30.0, rank="rank")
    return p.select("n_nationkey", "s_suppkey", _r("distance_km").alias("distance_km"), "rank")


# ---------------------------------------------------------------- sequencing, traffic
def previous_event_one(spark, sf):
    ev = b.table(spark, sf, "events")
    p = sequence.with_previous(ev, "user_id", ["ts"], ["event_id", "ts", "value"], prefix="prev_",
                               tie_break=["event_id"])
    return p.select("event_id", "user_id", "prev_event_id", "prev_ts", "prev_value")


def previous_event_number(spark, sf):
    """A clock that is a number: the customer's order before by order key."""
    o = b.table(spark, sf, "orders")
    p = sequence.with_previous(o, "o_custkey", ["o_orderkey"], ["o_orderkey", "o_totalprice"], prefix="prev_", tie_break=["o_orderkey"])
    return p.select("o_orderkey", "o_custkey", "prev_o_orderkey", "prev_o_totalprice")


def previous_event_all(spark, sf):
    li = b.table(spark, sf, "lineitem")
    p = sequence.with_previous(li, "l_suppkey", ["l_shipdate"], ["l_orderkey", "l_linenumber", "l_quantity"],
                               prefix="prev_", ties="all")
    return p.select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate",
                    "prev_l_orderkey", "prev_l_linenumber", "prev_l_quantity")


def hourly_rate(spark, sf):
    ev = b.flights(spark, sf)
    h = traffic.hourly_rate(ev, "event_type", "ts", "delayed", {"value": "mean_value"}, lag="2 hours",
                            bucket="hour_bucket", count_name="n", flagged_name="n_delayed", rate_name="rate", scale=2)
    return h.select("event_type", "hour_bucket", "n", "n_delayed", _r("mean_value").alias("mean_value"),
                    _r("rate").alias("rate"))


def rate_sink_restart(spark, sf):
    """Hourly rates in a table by day, the even days written a second time; read through a small table of days."""
    h = hourly_rate(spark, sf).withColumn("day", F.to_date("hour_bucket"))
    path = io.replace_partitions(h, scratch_path(spark, "rates"), ["day"])
    io.replace_partitions(h.where(F.dayofmonth("day") % 2 == 0), path, ["day"])
    back = spark.read.parquet(path)
    days = h.select("day").where(F.dayofmonth("day") <= 10).distinct()
    return back.join(days, "day").select("event_type", "hour_bucket", "n", "n_delayed", "mean_value", "rate", F.col("day").cast("string").alias("day"))


def lagged_rate(spark, sf):
    ev = b.flights(spark, sf)
    out = traffic.with_lagged_rate(ev, "event_type", "ts", "delayed", {"value": "hourly_mean"}, lag="2 hours",
                                   count_name="hourly_n", flagged_name="hourly_delayed", rate_name="hourly_rate",
                                   scale=2)
    return out.select("event_id", "hourly_n", "hourly_delayed", _r("hourly_rate").alias("hourly_rate"),
                      _r("hourly_mean").alias("hourly_mean"))


def dim_inner(spark, sf):
    c = b.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = b.table(spark, sf, "nation").select("n_nationkey", "n_name")
    return enrich.lookup(c, n, "n_nationkey", "inner").select("c_custkey", "n_nationkey", "n_name")


# ---------------------------------------------------------------- interval join and summaries
# Ten users share a station: its readings per hour do not grow with the table.
def _station():
    return F.floor(F.col("user_id") / 10)


def _readings(ev):
    return ev.select(_station().alias("r_station"), F.col("event_id").alias("r_event_id"),
                     F.col("ts").alias("r_ts"), F.col("value").alias("r_value"),
                     F.pmod(F.col("user_id"), F.lit(5)).alias("r_cat"))


def _matches(spark, sf):
    ev = b.table(spark, sf, "events")
    left = ev.select("event_id", _station().alias("station"), "ts")
    return interval.interval_join(left, _readings(ev), "station", "r_station", "ts", "r_ts",
                                  lo="-3 hours", hi="-2 hours")


def interval_match(spark, sf):
    return _matches(spark, sf).select("event_id", "r_event_id", "r_value")


def interval_summary(spark, sf):
    ev = b.table(spark, sf, "events").select("event_id")
    s = summarize.summarize(_matches(spark, sf), "event_id", means=["r_value"], modes=["r_cat"], scale=2)
    s = s.select("event_id", _r("r_value").alias("mean_value"), F.col("r_cat").alias("mode_cat"))
    return summarize.attach(ev, s, "event_id")


def _with_gaps(spark, sf):
    ev = b.table(spark, sf, "events")
    v = F.when(F.col("event_id") % 10 == 0, F.lit(None).cast("double")).when(F.col("event_id") % 11 == 0, F.lit(float("nan"))) \
        .otherwise(F.col("value"))
    place = F.when(F.col("event_id") % 7 != 0, F.col("event_type"))          # a null group
    return ev.select("event_id", place.alias("event_type"), v.alias("value"), clock.day_block("ts").alias("block"))


def group_median(spark, sf):
    g = summarize.group_percentile(_with_gaps(spark, sf), ["event_type", "block"], ["value"], 0.5, "_md")
    return g.select("event_type", "block", _r("value_md").alias("median_value"))


def impute_by_group(spark, sf):
    out = summarize.impute_by_group(_with_gaps(spark, sf), ["event_type", "block"], ["value"])
    return out.select("event_id", _r("value_imp").alias("value_imp"))


def mode_by_group(spark, sf):
    ev = b.table(spark, sf, "events")
    return summarize.mode_by(ev, "user_id", "event_type", out="mode_type")


def distinct_pairs(spark, sf):
    li = b.table(spark, sf, "lineitem")
    return summarize.distinct_rows(li, ["l_suppkey", "l_returnflag"])


def class_weights(spark, sf):
    sl = b.scored_lines(spark, sf)
    w = features.class_weights(sl, "label", out="weight")
    return w.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), _r(F.max("weight")).alias("weight"))


# ---------------------------------------------------------------- profiling
def _profile_input(spark, sf):
    ev = b.flights(spark, sf)
    v = F.when(F.col("event_id") % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
    t = F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type"))
    return ev.select("event_id", "user_id", t.alias("event_type"), v.alias("value"), "ts", "delayed")


def missing_profile(spark, sf):
    p = profile.profile_missing(_profile_input(spark, sf), ["event_id", "event_type", "value", "ts"])
    return p.select("column", "n_rows", "n_missing", _r("missing_share").alias("missing_share"))


def tail_bounds(spark, sf):
    ev = b.table(spark, sf, "events").select(F.when(F.col("event_id") % 11 != 0, F.col("value") - 50).when(
        F.col("event_id") % 2 == 0, F.lit(float("nan"))).alias("delay"))
    t = profile.tail_bounds(ev, "delay", 0.01, 0.99)
    return t.select("side", "prob", _r("bound").alias("bound"))


def measure_summary(spark, sf):
    li = b.table(spark, sf, "lineitem")
    d = profile.describe_measure(li, ["l_quantity", "l_discount", "l_tax"], scale=2)
    return d.select("column", "n", _r("mean").alias("mean"), _r("std").alias("std"), "min", "max")


def histogram(spark, sf):
    ev = b.table(spark, sf, "events")
    return profile.histogram(ev, "value", 0.0, 400.0, 20)


def mean_by_calendar(spark, sf):
    ev = b.flights(spark, sf).withColumn("dow", F.dayofweek("ts")).withColumn("hour", F.hour("ts"))
    m = profile.mean_by(ev, ["dow", "hour"], "value", out="mean_value", scale=2)
    return m.select("dow", "hour", "n", _r("mean_value").alias("mean_value"))


def rate_by_group(spark, sf):
    r = profile.rate_by(b.flights(spark, sf), ["event_type"], "delayed")
    return r.select("event_type", "n", "n_flagged", _r("rate").alias("rate"))


def conditional_rate(spark, sf):
    ev = b.flights(spark, sf)
    p = sequence.with_previous(ev, "user_id", ["ts"], ["delayed"], prefix="prev_", tie_break=["event_id"])
    r = profile.conditional_rate(p, "prev_delayed", "delayed")
    return r.select("prev_delayed", "n", "n_flagged", _r("rate").alias("rate"))


def box_summary(spark, sf):
    ev = b.flights(spark, sf)
    ev = ev.select(F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event_type"),
                   F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    s = profile.box_summary(ev, ["event_type"], ["value"])
    return s.select("event_type", "measure", "prob", _r("value").alias("value"))


def correlation_matrix(spark, sf):
    li = b.table(spark, sf, "lineitem")
    c = profile.correlation_matrix(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return c.select("col_a", "col_b", _r("corr").alias("corr"))


def category_share(spark, sf):
    li = b.table(spark, sf, "lineitem")
    s = profile.share_by(li, "l_returnflag", "l_linestatus")
    return s.select("l_returnflag", "l_linestatus", "n", _r("share").alias("share"))


def audit_unique(spark, sf):
    return profile.audit_unique(b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def exclusion_ledger(spark, sf):
    ev = b.flights(spark, sf)
    steps = {"user_known": "user_id IS NOT NULL", "value_positive": "value > 1",
             "value_trimmed": "value < 450", "not_error": "event_type <> 'error'"}
    e = profile.exclusion_ledger(ev, steps, "delayed")
    return e.select("step", "name", "n_rows", _r("n_flagged").alias("n_flagged"), _r("flag_rate").alias("flag_rate"))


def gini_by_feature(spark, sf):
    li = b.table(spark, sf, "lineitem")
    d = li.select((F.col("l_returnflag") == "R").cast("int").alias("label"), "l_linestatus", "l_linenumber",
                  F.when(F.col("l_discount") >= 0.05, F.lit("high")).otherwise(F.lit("low")).alias("disc_band"))
    g = profile.gini_by_feature(d, "label", ["l_linestatus", "l_linenumber", "disc_band"])
    return g.select("feature", _r("gini").alias("gini"))


def sort_top_n(spark, sf):
    ev = b.table(spark, sf, "events")
    return ev.orderBy(F.desc("value"), F.asc("event_id")).limit(20).select("event_id", "user_id", "value")


# ---------------------------------------------------------------- scoring
def confusion(spark, sf):
    return evaluate.confusion(b.scored_lines(spark, sf), "label", "prediction")


def _metric_cols(df, *lead):
    return df.select(*lead, "tp", "fp", "tn", "fn", *[_r(c).alias(c) for c in (
        "accuracy", "precision_macro", "recall_macro", "f1_macro", "balanced_accuracy", "roc_auc_hard")])


def class_metrics(spark, sf):
    return _metric_cols(evaluate.class_metrics(b.scored_lines(spark, sf), "label", "prediction"))


def average_precision(spark, sf):
    ap = evaluate.average_precision(b.scored_lines(spark, sf), "label", "score")
    return ap.select(_r("average_precision").alias("average_precision"))


def roc_curve(spark, sf):
    r = evaluate.roc_curve(b.scored_lines(spark, sf), "label", "score")
    return r.select("score", _r("fpr").alias("fpr"), _r("tpr").alias("tpr"))


def roc_auc(spark, sf):
    r = evaluate.roc_auc(b.scored_lines(spark, sf), "label", "score")
    return r.select(_r("roc_auc").alias("roc_auc"))


def pr_curve(spark, sf):
    r = evaluate.pr_curve(b.scored_lines(spark, sf), "label", "score")
    return r.select("score", _r("precision").alias("precision"), _r("recall").alias("recall"))


def model_compare(spark, sf):
    sl = b.scored_lines(spark, sf)
    runs = {"cut_0.4": sl.withColumn("prediction", (F.col("score") > 0.4).cast("int")),
            "cut_0.6": sl}
    return _metric_cols(evaluate.compare_models(runs, "label", "prediction"), "model")


# ---------------------------------------------------------------- splits and features
def hash_split(spark, sf):
    ev = b.table(spark, sf, "events")
    return features.hash_split(ev, "event_id", 80, seed=7, out="is_train").select("event_id", "is_train")


def hash_subsample(spark, sf):
    ev = b.table(spark, sf, "events")
    return features.subsample(ev, 0.3, "event_id", seed=7).select("event_id")


def index_categories(spark, sf):
    from pyspark.ml.feature import StringIndexer
    li = b.table(spark, sf, "lineitem")
    m = StringIndexer(inputCols=["l_returnflag", "l_linestatus"], outputCols=["rf_idx", "ls_idx"],
                      stringOrderType="frequencyDesc").fit(li)
    return m.transform(li).select("l_orderkey", "l_linenumber", F.col("rf_idx").cast("int").alias("rf_idx"),
                                  F.col("ls_idx").cast("int").alias("ls_idx"))


def onehot_features(spark, sf):
    from pyspark.ml.functions import vector_to_array
    li = b.table(spark, sf, "lineitem")
    _, out = features.build_features(li, ["l_quantity", "l_discount"], ["l_returnflag", "l_linestatus"],
                                     handle_invalid="error")
    arr = vector_to_array("features")
    # + 0.0 folds a -0.0 to 0.0 (vectors may keep or drop the sign of a zero)
    return out.select("l_orderkey", "l_linenumber", *[(arr.getItem(i) + 0.0).alias(f"f{i}") for i in range(7)])


# ---------------------------------------------------------------- models
# On the slots of one category (and a constant number, which no model can use) the fitted models have a closed form:
# the weighted share of positives per category; a tree keeps one leaf for categories that it predicts alike.
_NUM, _CAT, _KEY = ["flat"], ["kind"], ["l_orderkey", "l_linenumber"]
_PLAIN = dict(bootstrap=False, subset="all", seed=7)       # each tree sees all rows and slots; 60 trees, depth 8, 32 bins


def _model_rows(spark, sf):
    li = b.table(spark, sf, "lineitem")
    k = F.col("l_linenumber") % 3
    label = F.col("l_discount") >= F.when(k == 0, 0.02).otherwise(0.08)
    return li.select(*_KEY, F.concat(F.lit("k"), k.cast("string")).alias("kind"), F.lit(1.0).alias("flat"), label.cast("double").alias("label"))


def _model_input(spark, sf):
    # the train side is read by the weights, the indexer and every pass of a fit: written, as are its features
    train, test = features.split(_model_rows(spark, sf), _KEY, 80, seed=7)
    fm, train_f = features.build_features(features.class_weights(io.stage(train), "label"), _NUM, _CAT)
    return io.stage(train_f.select(*_KEY, "label", "classWeights", "features")), fm.transform(test)


def _scores(scored, decimals, *more):
    from pyspark.ml.functions import vector_to_array
    p = vector_to_array("probability").getItem(1)
    return scored.select(*_KEY, F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"),
                         _r(p, decimals).alias("score"), *more)


def logistic_scores(spark, sf):
    from aloft.operators import models
    train, test = _model_input(spark, sf)
    _, _, scored = models.fit_and_score(models.logistic(max_iter=50), train, test)
    return _scores(scored, 3)


def logistic_threshold(spark, sf):
    from aloft.operators import models
    train, test = _model_input(spark, sf)
    _, _, scored = models.fit_and_score(models.logistic(max_iter=50, threshold=0.6), train, test)
    return _scores(scored, 3)


def logistic_tuned(spark, sf):
    from aloft.operators import models
    train, test = _model_input(spark, sf)
    cv = models.tune(models.logistic(threshold=0.6), train, {"regParam": [0.0, 1.0], "maxIter": [100]}, folds=3, seed=7, fold_key=_KEY)
    best = models.best_parameters(cv, ["regParam", "maxIter"])
    return _scores(cv.transform(test), 3, F.lit(float(best["regParam"])).alias("reg_param"), F.lit(int(best["maxIter"])).alias("max_iter"))


def logistic_fold_scores(spark, sf):
    from aloft.operators import models
    train, _ = _model_input(spark, sf)
    cv = models.tune(models.logistic(threshold=0.6), train, {"regParam": [0.0], "maxIter": [100]}, folds=3, seed=8, fold_key=_KEY, keep_models=True)
    return _metric_cols(models.fold_scores(cv, train, _KEY, seed=8), "fold")


def forest_scores(spark, sf):
    from aloft.operators import models
    train, test = _model_input(spark, sf)
    _, _, scored = models.fit_and_score(models.forest(**_PLAIN), train, test)
    return _scores(scored, 6)


def forest_importance(spark, sf):
    from aloft.operators import models
    train, _ = _model_input(spark, sf)
    imp = features.feature_importance(spark, models.forest(**_PLAIN).fit(train), train)
    total = imp.agg(F.sum("score").alias("total"))
    return imp.crossJoin(F.broadcast(total)).select("name", "idx", (F.col("score") >= 1.0).alias("selected"), _r("total").alias("total"))


def forest_selected(spark, sf):
    from aloft.operators import models
    train, test = _model_input(spark, sf)
    imp = features.feature_importance(spark, models.forest(**_PLAIN).fit(train), train)
    slots = [i for i, _ in features.select_features(imp, 1.0)]
    _, _, scored = models.fit_and_score(models.forest(**_PLAIN), features.keep_slots(train, slots), features.keep_slots(test, slots))
    return _scores(scored, 6)


def learning_curve(spark, sf):
    from aloft.operators import models
    c = models.learning_curve(_model_rows(spark, sf), "label", _NUM, _KEY, _CAT, fracs=(1.0, 0.5, 0.25),
                              make_estimator=lambda: models.forest(**_PLAIN), seed=7)
    return c.select("fraction", "n_test", _r("f1_macro").alias("f1_macro"), _r("accuracy").alias("accuracy"))


# ---------------------------------------------------------------- the study end to end
def _study_table(spark, sf, columns=None):
    from aloft.plans import flight_study as fs
    tb = fs.TestBinding()
    return fs.feature_table(b.study_flights(spark, sf), b.study_observations(spark, sf), b.study_places(spark, sf),
                            b.study_state_tz(spark), b.study_city_tz(spark), tb.fspec, tb.ospec, columns=columns or fs.FINAL)


def study_features(spark, sf, columns=None):
    from aloft.plans import flight_study as fs
    out = _study_table(spark, sf, columns)
    measures = {"HOURLY_DELAY_RATE", "WindAngle", "SeaLevelPressure", *[c + "_imp" for c in fs.IMPUTED]}
    return out.select(*[_r(c).alias(c) if c in measures else F.col(c) for c in columns or fs.FINAL])


def study_correlation(spark, sf):
    """All pairs of the numeric columns of the study's table (which is written already)."""
    from aloft.plans import flight_study as fs
    return profile.correlation_matrix(study_features(spark, sf, fs.NUMERIC), fs.NUMERIC).select("col_a", "col_b", _r("corr").alias("corr"))


def study_model(spark, sf):
    """The study's basic models on its own feature table: metrics of train and test for each."""
    from aloft.operators import models
    from aloft.plans import study_models as sm
    (train_f, test_f), out = sm.train_and_test(_study_table(spark, sf, sm.COLUMNS)), None
    for name, est in (("logistic", models.logistic(max_iter=50)), ("forest", models.forest(seed=7))):
        m = models.train_and_test_metrics(est.fit(train_f), train_f, test_f).withColumn("model", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return _metric_cols(out, "model", "side")


def study_importance(spark, sf):
    from aloft.plans import study_models as sm
    return sm.importance(spark, _study_table(spark, sf, sm.COLUMNS))


def study_selected(spark, sf):
    from aloft.plans import study_models as sm
    return _metric_cols(sm.selected(spark, _study_table(spark, sf, sm.COLUMNS)), "side", "n_slots", "slots")


def study_learning_curve(spark, sf):
    from aloft.plans import study_models as sm
    return _metric_cols(sm.learning_curve(_study_table(spark, sf, sm.COLUMNS)), "fraction", "side")


def study_fraction_rows(spark, sf):
    from aloft.plans import study_models as sm
    return sm.fraction_rows(_study_table(spark, sf, sm.COLUMNS))


def study_tuned(spark, sf):
    from aloft.plans import study_models as sm
    return _metric_cols(sm.tuned(_study_table(spark, sf, sm.COLUMNS)), "side", F.col("regParam").alias("reg_param"), F.col("maxIter").alias("max_iter"))


def study_gradient(spark, sf):
    from aloft.plans import study_models as sm
    return sm.gradient(_study_table(spark, sf, sm.COLUMNS))


def study_curve_areas(spark, sf):
    from aloft.plans import study_models as sm
    return sm.curve_areas(_study_table(spark, sf, sm.COLUMNS)).select("model", "side", _r("average_precision").alias("average_precision"), _r("roc_auc").alias("roc_auc"))


def study_roc_curve(spark, sf):
    from aloft.plans import study_models as sm
    return sm.roc_curve(_study_table(spark, sf, sm.COLUMNS))


QUERIES: dict[str, Query] = {name: fn for name, fn in {
    "scan_project_filter": scan_project_filter, "csv_named_roundtrip": csv_named_roundtrip,
    "literal_dimension": literal_dimension, "stable_row_key": stable_row_key,
    "sentinel_to_null": sentinel_to_null, "fill_then_drop_null": fill_then_drop_null,
    "outlier_trim": outlier_trim, "region_filter": region_filter,
    "decode_wind": decode_wind, "decode_ceiling": decode_ceiling, "decode_visibility": decode_visibility,
    "decode_temperature": decode_temperature, "decode_dew": decode_dew, "decode_pressure": decode_pressure,
    "decode_cloud": decode_cloud, "decode_condition": decode_condition,
    "decode_reject_report": decode_reject_report,
    "hhmm_clock": hhmm_clock, "clock_shift_bucket": clock_shift_bucket,
    "minutes_signed": minutes_signed, "minutes_wrapped": minutes_wrapped,
    "local_to_utc": local_to_utc, "day_block": day_block, "indicator_flags": indicator_flags,
    "haversine_pairs": haversine_pairs, "nearest_three": nearest_three,
    "dense_pairs": dense_pairs, "previous_event_number": previous_event_number, "rate_sink_restart": rate_sink_restart,
    "previous_event_one": previous_event_one, "previous_event_all": previous_event_all,
    "hourly_rate": hourly_rate, "lagged_rate": lagged_rate, "dim_inner": dim_inner,
    "interval_match": interval_match, "interval_summary": interval_summary,
    "group_median": group_median, "impute_by_group": impute_by_group, "mode_by_group": mode_by_group,
    "distinct_pairs": distinct_pairs, "class_weights": class_weights,
    "missing_profile": missing_profile, "tail_bounds": tail_bounds, "measure_summary": measure_summary,
    "histogram": histogram, "mean_by_calendar": mean_by_calendar, "rate_by_group": rate_by_group,
    "conditional_rate": conditional_rate, "box_summary": box_summary,
    "correlation_matrix": correlation_matrix, "category_share": category_share,
    "audit_unique": audit_unique, "exclusion_ledger": exclusion_ledger, "gini_by_feature": gini_by_feature,
    "sort_top_n": sort_top_n,
    "confusion": confusion, "class_metrics": class_metrics, "average_precision": average_precision,
    "roc_curve": roc_curve, "roc_auc": roc_auc, "pr_curve": pr_curve, "model_compare": model_compare,
    "hash_split": hash_split, "hash_subsample": hash_subsample,
    "index_categories": index_categories, "onehot_features": onehot_features,
    "logistic_scores": logistic_scores, "logistic_threshold": logistic_threshold,
    "logistic_tuned": logistic_tuned, "logistic_fold_scores": logistic_fold_scores, "forest_scores": forest_scores,
    "forest_importance": forest_importance, "forest_selected": forest_selected,
    "learning_curve": learning_curve, "study_features": study_features, "study_model": study_model,
    "study_correlation": study_correlation,
    "study_importance": study_importance, "study_selected": study_selected, "study_learning_curve": study_learning_curve,
    "study_fraction_rows": study_fraction_rows, "study_tuned": study_tuned, "study_gradient": study_gradient,
    "study_curve_areas": study_curve_areas, "study_roc_curve": study_roc_curve,
}.items()}
