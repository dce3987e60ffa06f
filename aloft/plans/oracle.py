"""DuckDB SQL oracles for the registered queries.

Written from the operator semantics, not generated from the Spark code:
rank self-joins where Spark uses windows, cross joins where Spark uses the
grid, plain ``quantile_cont`` where Spark uses bucketed exact quantiles,
``lag`` where Spark uses segmented windows, the closed form of a fit on one
category where Spark trains a model.
"""

from __future__ import annotations

from aloft.plans.catalog import NAME_ZONES, REGION_ZONES

# The layout of the composite fields, spelled out for the SQL side: source, parts of a well-formed
# value, the value and its quality code (counted from 1), the missing marker, type, divisor.  An empty
# GD1 or AW means missing.
_LAYOUT = {
    "WindAngle": ("WND", 5, 1, 2, "999", "INTEGER", ""),
    "WindSpeed": ("WND", 5, 4, 5, "9999", "INTEGER", ""),
    "VerticalVisibility": ("CIG", 4, 1, 2, "99999", "INTEGER", ""),
    "Visibility": ("VIS", 4, 1, 2, "999999", "INTEGER", ""),
    "Temperature": ("TMP", 2, 1, 2, "999.9", "DOUBLE", " / CAST(10 AS DOUBLE)"),
    "DewPointTemp": ("DEW", 2, 1, 2, "999.9", "DOUBLE", " / CAST(10 AS DOUBLE)"),
    "SeaLevelPressure": ("SLP", 2, 1, 2, "99999", "INTEGER", ""),
    "CloudMode": ("GD1", 6, 1, 3, "9", "INTEGER", ""),
    "CloudHeight": ("GD1", 6, 4, 5, "99999", "INTEGER", ""),
    "AtmCondition": ("AW", 2, 1, 2, "9999", "INTEGER", ""),
}
_BAD = "'2', '3', '6', '7'"


def _values(rows) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


ZONES = f"""rz(state, state_tz) AS (VALUES {_values(REGION_ZONES)}),
nz(tt_city, tt_tz) AS (VALUES {_values(NAME_ZONES)})"""

FLIGHTS = "ev AS (SELECT *, CAST(value > 80 AS INTEGER) AS delayed FROM events)"

DAY_BLOCK = """strftime(ts - INTERVAL 150 MINUTE, '%Y-%m-%d') || ' ' ||
  CASE WHEN hour(ts - INTERVAL 150 MINUTE) < 6 THEN 'early'
       WHEN hour(ts - INTERVAL 150 MINUTE) < 12 THEN 'morning'
       WHEN hour(ts - INTERVAL 150 MINUTE) < 18 THEN 'afternoon' ELSE 'night' END"""

OBS = """obs AS (
  SELECT l_orderkey, l_linenumber, l_suppkey,
    CASE WHEN l_orderkey % 101 = 0
         THEN concat_ws(',', lpad(CAST(angle AS VARCHAR), 3, '0'), q, 'N', lpad(CAST(speed AS VARCHAR), 4, '0'))
         ELSE concat_ws(',', lpad(CAST(angle AS VARCHAR), 3, '0'), q, 'N', lpad(CAST(speed AS VARCHAR), 4, '0'), q) END AS WND,
    concat_ws(',', lpad(CAST(vv AS VARCHAR), 5, '0'), q, 'M', 'N') AS CIG,
    concat_ws(',', lpad(CAST(vis AS VARCHAR), 6, '0'), q, 'N', '1') AS VIS,
    concat_ws(',', CASE WHEN l_partkey % 43 = 0 THEN '+9999'
                        ELSE (CASE WHEN t < 0 THEN '-' ELSE '+' END) || lpad(CAST(abs(t) AS VARCHAR), 4, '0') END, q) AS TMP,
    concat_ws(',', CASE WHEN l_suppkey % 47 = 0 THEN '+9999'
                        ELSE (CASE WHEN d < 0 THEN '-' ELSE '+' END) || lpad(CAST(abs(d) AS VARCHAR), 4, '0') END, q) AS DEW,
    concat_ws(',', lpad(CAST(slp AS VARCHAR), 5, '0'), q) AS SLP,
    CASE WHEN l_orderkey % 13 = 0 THEN ''
         ELSE concat_ws(',', CAST(l_partkey % 10 AS VARCHAR), '99', q, '+' || lpad(CAST(height AS VARCHAR), 5, '0'), q, '9') END AS GD1,
    CASE WHEN l_orderkey % 3 = 0 THEN '' WHEN l_orderkey % 3 = 1 THEN NULL
         ELSE lpad(CAST(l_partkey % 100 AS VARCHAR), 2, '0') || ',' || q END AS AW1,
    CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE lpad(CAST(l_suppkey % 100 AS VARCHAR), 2, '0') || ',' || q END AS AW2
  FROM (SELECT *, CAST(l_linenumber AS VARCHAR) AS q,
          CASE WHEN l_partkey % 37 = 0 THEN 999 ELSE l_partkey % 360 END AS angle,
          CASE WHEN l_suppkey % 29 = 0 THEN 9999 ELSE CAST(l_quantity AS INTEGER) * 3 END AS speed,
          CASE WHEN l_partkey % 31 = 0 THEN 99999 ELSE (l_partkey * 7) % 22000 END AS vv,
          CASE WHEN l_suppkey % 23 = 0 THEN 999999 ELSE (l_partkey * 13) % 20000 END AS vis,
          CAST(l_quantity AS INTEGER) * 7 - 100 AS t,
          CAST(l_quantity AS INTEGER) * 5 - 120 AS d,
          CASE WHEN l_partkey % 41 = 0 THEN 99999 ELSE 9900 + l_partkey % 400 END AS slp,
          CASE WHEN l_suppkey % 19 = 0 THEN 99999 ELSE (l_partkey * 11) % 30000 END AS height
        FROM lineitem) x),
obs2 AS (SELECT *, coalesce(nullif(trim(AW1), ''), nullif(trim(AW2), '')) AS AW FROM obs)"""


def _field_parts(name):
    src, parts, value, quality, missing, typ, divide = _LAYOUT[name]
    arr, blank = f"string_split({src}, ',')", src in ("GD1", "AW")
    val = f"TRY_CAST({arr}[{value}] AS {typ})"
    ok = f"len({arr}) = {parts} AND {val} IS NOT NULL" + (f" AND {src} <> ''" if blank else "")
    scaled = f"({val}{divide})"
    return src, f"({ok})", f"({arr}[{quality}] IN ({_BAD}))", f"({scaled} = CAST({missing} AS {typ}))", scaled, blank


def _field(name):
    src, ok, bad, sent, scaled, _ = _field_parts(name)
    return f"CASE WHEN {ok} AND NOT {bad} AND NOT {sent} THEN {scaled} END AS {name}"


def _decode_sql(names):
    return f"WITH {OBS} SELECT l_orderkey, l_linenumber, " + ", ".join(_field(n) for n in names) + " FROM obs2"


def _reject_sql():
    parts = []
    for name in _LAYOUT:
        src, ok, bad, sent, _, em = _field_parts(name)
        empty = f"({src} = '')" if em else "FALSE"
        parts.append(
            f"SELECT count(*) AS n_rows, '{name}' AS field, "
            f"CAST(count_if({src} IS NULL) AS BIGINT) AS n_null_source, "
            f"CAST(count_if({src} IS NOT NULL AND NOT {empty} AND NOT coalesce({ok}, FALSE)) AS BIGINT) AS n_malformed, "
            f"CAST(count_if({src} IS NOT NULL AND {empty}) AS BIGINT) AS n_empty, "
            f"CAST(count_if(coalesce({ok}, FALSE) AND {bad}) AS BIGINT) AS n_bad_quality, "
            f"CAST(count_if(coalesce({ok}, FALSE) AND NOT {bad} AND {sent}) AS BIGINT) AS n_sentinel, "
            f"CAST(count_if(coalesce({ok}, FALSE) AND NOT {bad} AND NOT {sent}) AS BIGINT) AS n_valid FROM obs2")
    return f"WITH {OBS} " + " UNION ALL ".join(parts)


NATION_PTS = """np AS (SELECT n_nationkey, CAST(40.0 AS DOUBLE) + (n_nationkey % 5) * CAST(0.5 AS DOUBLE) AS lat,
                CAST(-100.0 AS DOUBLE) + floor(n_nationkey / 5) * CAST(0.5 AS DOUBLE) AS lon FROM nation),
sp AS (SELECT s_suppkey, CAST(40.01 AS DOUBLE) + (s_suppkey % 10) * CAST(0.23 AS DOUBLE) AS lat,
              CAST(-100.02 AS DOUBLE) + (floor(s_suppkey / 10) % 10) * CAST(0.24 AS DOUBLE) AS lon FROM supplier),
pairs AS (SELECT n_nationkey, s_suppkey, CAST(6371.0 AS DOUBLE) * (2 * atan2(sqrt(a), sqrt(1 - a))) AS dist
  FROM (SELECT n_nationkey, s_suppkey,
          sin(radians(sp.lat - np.lat) / 2) * sin(radians(sp.lat - np.lat) / 2)
          + cos(radians(np.lat)) * cos(radians(sp.lat)) * sin(radians(sp.lon - np.lon) / 2) * sin(radians(sp.lon - np.lon) / 2) AS a
        FROM np CROSS JOIN sp) x)"""

SCORED = """s AS (SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) AS label,
  round(l_discount * 5 + l_tax * 3 + l_quantity / 100, 4) AS score FROM lineitem),
s2 AS (SELECT *, CAST(score > 0.6 AS INTEGER) AS prediction FROM s)"""

CUM = """g AS (SELECT score, CAST(sum(label) AS BIGINT) AS tp, CAST(sum(1 - label) AS BIGINT) AS fp FROM s GROUP BY score),
c AS (SELECT score, tp, fp, sum(tp) OVER (ORDER BY score DESC) AS cum_tp, sum(fp) OVER (ORDER BY score DESC) AS cum_fp,
             sum(tp) OVER () AS P, sum(fp) OVER () AS N FROM g)"""


def _metrics(src: str, model: str | None = None) -> str:
    m = f"'{model}' AS model, " if model else ""
    return f"""SELECT {m}tp, fp, tn, fn,
  (floor(((tp + tn) / (tp + fp + tn + fn)) * 1000000.0 + 0.5) / 1000000.0) AS accuracy,
  (floor(((p1 + p0) / 2) * 1000000.0 + 0.5) / 1000000.0) AS precision_macro,
  (floor(((r1 + r0) / 2) * 1000000.0 + 0.5) / 1000000.0) AS recall_macro,
  (floor(((coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) + coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0)) / 2) * 1000000.0 + 0.5) / 1000000.0) AS f1_macro,
  (floor(((r1 + r0) / 2) * 1000000.0 + 0.5) / 1000000.0) AS balanced_accuracy,
  (floor(((r1 + r0) / 2) * 1000000.0 + 0.5) / 1000000.0) AS roc_auc_hard
FROM (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tn / nullif(tn + fn, 0), 0) AS p0,
             coalesce(tp / nullif(tp + fn, 0), 0) AS r1, coalesce(tn / nullif(tn + fp, 0), 0) AS r0
      FROM (SELECT CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp, CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp,
                   CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS tn, CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn
            FROM {src}) c0) c1"""


def _hex8(expr: str) -> str:
    return f"CAST(('0x' || substr(md5({expr}), 1, 8)) AS BIGINT)"


def _quantile_union(table: str, col: str, probs, by: str, measure: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {by}, '{measure}' AS measure, CAST({p} AS DOUBLE) AS prob, (floor((quantile_cont({col}, {p})) * 1000000.0 + 0.5) / 1000000.0) AS value "
        f"FROM {table} GROUP BY {by}" for p in probs)


MATCHES = """m AS (SELECT l.event_id, r.event_id AS r_event_id, r.value AS r_value, r.user_id % 5 AS r_cat
  FROM events l JOIN events r ON l.user_id // 10 = r.user_id // 10
   AND r.ts > l.ts - INTERVAL 3 HOUR AND r.ts < l.ts - INTERVAL 2 HOUR)"""

# missing values (null, and NaN in the Spark binding) are NULL here
GAPS = f"""gp AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type,
  CASE WHEN event_id % 10 = 0 OR event_id % 11 = 0 THEN NULL ELSE value END AS value,
  {DAY_BLOCK} AS block FROM events)"""

PREV = """p AS (SELECT event_id, ts, lag(event_id) OVER w AS prev_event_id, lag(ts) OVER w AS prev_ts,
                  lag(value) OVER w AS prev_value FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


def _gap_sql(wrap: bool) -> str:
    us = "(epoch_us(ts) - epoch_us(prev_actual))"
    gap = (f"CAST(((({us} % 86400000000) + 86400000000) % 86400000000) // 60000000 AS INTEGER)" if wrap
           else f"CAST({us} // 60000000 AS INTEGER)")
    return f"""WITH {PREV},
q AS (SELECT *, prev_ts + to_microseconds(CAST(floor(prev_value * 60) AS BIGINT) * 1000000) AS prev_actual
      FROM p WHERE prev_event_id IS NOT NULL)
SELECT event_id, prev_event_id, {gap} AS gap_min, {gap} - prev_value AS prep_min FROM q"""


def _missing_sql() -> str:
    src = """pf AS (SELECT event_id, CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_type END AS event_type,
                  CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value, ts FROM events)"""
    parts = []
    for c, extra in (("event_id", ""), ("event_type", ""), ("value", " OR isnan(value)"), ("ts", "")):
        miss = f"({c} IS NULL{extra})"
        parts.append(f"SELECT '{c}' AS \"column\", count(*) AS n_rows, CAST(count_if({miss}) AS BIGINT) AS n_missing, "
                     f"(floor((CAST(count_if({miss}) AS BIGINT) / count(*)) * 1000000.0 + 0.5) / 1000000.0) AS missing_share FROM pf")
    return f"WITH {src} " + " UNION ALL ".join(parts)


def _describe_sql(cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, (floor((CAST(sum(CAST({c} AS DECIMAL(38,2))) AS DOUBLE) / count({c})) * 1000000.0 + 0.5) / 1000000.0) AS mean, (floor((stddev_samp({c})) * 1000000.0 + 0.5) / 1000000.0) AS std, "
        f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem" for c in cols)


def _corr_sql(cols) -> str:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, (floor((corr({a}, {b})) * 1000000.0 + 0.5) / 1000000.0) AS corr FROM lineitem" for a, b in pairs)


def _ledger_sql() -> str:
    steps = [("input", "TRUE"), ("user_known", "user_id IS NOT NULL"), ("value_positive", "value > 1"),
             ("value_trimmed", "value < 450"), ("not_error", "event_type <> 'error'")]
    parts, acc = [], []
    for i, (name, cond) in enumerate(steps):
        acc.append(cond)
        w = " AND ".join(acc)
        parts.append(f"SELECT {i} AS step, '{name}' AS name, count(*) AS n_rows, "
                     f"(floor((CAST(sum(delayed) AS DOUBLE)) * 1000000.0 + 0.5) / 1000000.0) AS n_flagged, "
                     f"(floor((sum(delayed) / count(*)) * 1000000.0 + 0.5) / 1000000.0) AS flag_rate FROM ev WHERE {w}")
    return f"WITH {FLIGHTS} " + " UNION ALL ".join(parts)


def _gini_sql() -> str:
    return """WITH d AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, l_linestatus,
                CAST(l_linenumber AS VARCHAR) AS l_linenumber,
                CASE WHEN l_discount >= 0.05 THEN 'high' ELSE 'low' END AS disc_band FROM lineitem),
lg AS (SELECT 'l_linestatus' AS feature, l_linestatus AS value, label FROM d
       UNION ALL SELECT 'l_linenumber', l_linenumber, label FROM d
       UNION ALL SELECT 'disc_band', disc_band, label FROM d),
c AS (SELECT feature, value, label, count(*) AS n FROM lg GROUP BY ALL),
v AS (SELECT feature, value, sum(n) AS nv, sum(n * n) AS sq FROM c GROUP BY ALL)
SELECT feature, (floor((sum(nv * (1 - sq / (nv * nv))) / sum(nv)) * 1000000.0 + 0.5) / 1000000.0) AS gini FROM v GROUP BY feature"""


def _index_sql() -> str:
    return """WITH rf AS (SELECT l_returnflag, CAST(row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS INTEGER) AS rf_idx
            FROM lineitem GROUP BY l_returnflag),
ls AS (SELECT l_linestatus, CAST(row_number() OVER (ORDER BY count(*) DESC, l_linestatus) - 1 AS INTEGER) AS ls_idx
       FROM lineitem GROUP BY l_linestatus)"""


ORACLE: dict[str, str] = {
    "scan_project_filter": """SELECT l_orderkey AS order_key, l_linenumber AS line, l_quantity AS qty,
  l_extendedprice * (1 - l_discount) AS net_price, l_shipdate AS ship_ts FROM lineitem
  WHERE l_linestatus = 'F' AND l_shipdate IS NOT NULL AND l_discount IS NOT NULL AND l_quantity IS NOT NULL""",
    "csv_named_roundtrip": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "literal_dimension": f"""WITH {ZONES} SELECT n_nationkey, n_name, coalesce(nz.tt_tz, rz.state_tz) AS tz
  FROM nation LEFT JOIN rz ON n_regionkey = rz.state LEFT JOIN nz ON n_name = nz.tt_city""",
    "stable_row_key": """WITH d AS (SELECT l_suppkey, nullif(l_linenumber, 3) AS line, nullif(l_returnflag, 'A') AS flag, l_linestatus FROM lineitem),
k AS (SELECT *, md5(coalesce(length(CAST(l_suppkey AS VARCHAR)) || ':' || l_suppkey, '-') || coalesce(length(CAST(line AS VARCHAR)) || ':' || line, '-')
  || coalesce(length(flag) || ':' || flag, '-') || coalesce(length(l_linestatus) || ':' || l_linestatus, '-')) AS key FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY key) AS nth FROM k)
SELECT l_suppkey, line, flag, l_linestatus, CASE WHEN nth > 1 THEN key || '-' || nth ELSE key END AS row_key FROM n""",
    "sentinel_to_null": """SELECT l_orderkey, l_linenumber, nullif(l_discount, CAST(0.0 AS DOUBLE)) AS discount,
  nullif(l_tax, CAST(0.0 AS DOUBLE)) AS tax,
  CASE WHEN nullif(l_discount, CAST(0.0 AS DOUBLE)) IS NULL THEN 'none' WHEN l_discount >= 0.05 THEN 'high' ELSE 'low' END AS disc_band
  FROM lineitem""",
    "fill_then_drop_null": f"""WITH {FLIGHTS},
rate AS (SELECT event_type, date_trunc('hour', ts + INTERVAL 2 HOUR) AS hb, count(*) AS hourly_n,
         CAST(sum(delayed) AS BIGINT) AS hourly_delayed, sum(delayed) / count(*) AS hourly_rate FROM ev GROUP BY ALL),
j AS (SELECT ev.event_id, ev.user_id, ev.ts, ev.value, coalesce(r.hourly_n, 0) AS hourly_n,
             coalesce(r.hourly_rate, 0) AS hourly_rate, r.hourly_delayed
      FROM ev LEFT JOIN rate r ON ev.event_type = r.event_type AND date_trunc('hour', ev.ts) = r.hb),
p AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_value FROM j)
SELECT event_id, hourly_n, (floor((hourly_rate) * 1000000.0 + 0.5) / 1000000.0) AS hourly_rate, prev_value FROM p
WHERE prev_value IS NOT NULL AND hourly_rate IS NOT NULL AND hourly_delayed IS NOT NULL""",
    "outlier_trim": "SELECT event_id, value FROM events WHERE value > 5 AND value < 450 AND user_id > 0",
    "region_filter": """WITH c AS (SELECT c_custkey,
    CASE WHEN c_custkey % 7 = 0 THEN concat_ws(', ', c_name, 'X', concat_ws(' ', st, ct))
         WHEN c_custkey % 11 = 0 THEN c_name || ', ' || st || ' ' || ct || ' Z'
         ELSE c_name || ', ' || st || ' ' || ct END AS NAME
  FROM (SELECT *, 'S' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS st,
               ['US', 'GQ', 'AQ', 'CA', 'MX'][c_nationkey % 5 + 1] AS ct FROM customer) x),
w AS (SELECT c_custkey, string_split(NAME, ',') AS parts, string_split(trim(string_split(NAME, ',')[2]), ' ') AS words FROM c)
SELECT c_custkey, parts[1] AS StationName, words[1] AS State FROM w
WHERE len(parts) = 2 AND len(words) = 2 AND words[2] IN ('US', 'GQ', 'AQ')""",
    "decode_wind": _decode_sql(["WindAngle", "WindSpeed"]),
    "decode_ceiling": _decode_sql(["VerticalVisibility"]),
    "decode_visibility": _decode_sql(["Visibility"]),
    "decode_temperature": _decode_sql(["Temperature"]),
    "decode_dew": _decode_sql(["DewPointTemp"]),
    "decode_pressure": _decode_sql(["SeaLevelPressure"]),
    "decode_cloud": _decode_sql(["CloudMode", "CloudHeight"]),
    "decode_condition": _decode_sql(["AtmCondition"]),
    "decode_reject_report": _reject_sql(),
    "hhmm_clock": """WITH h AS (SELECT l_orderkey, l_linenumber, l_shipdate,
    CAST(CASE WHEN l_linenumber = 7 THEN 2400 ELSE (CAST(l_quantity AS INTEGER) % 24) * 100 + l_partkey % 60 END AS INTEGER) AS hhmm
  FROM lineitem),
k AS (SELECT *, hhmm // 100 AS hh, hhmm - (hhmm // 100) * 100 AS mi FROM h)
SELECT l_orderkey, l_linenumber, hhmm,
  make_timestamp(year(l_shipdate), month(l_shipdate), day(l_shipdate), CASE WHEN hh = 24 THEN 0 ELSE hh END, mi, 0)
    + CASE WHEN hh = 24 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS ts_next_day,
  make_timestamp(year(l_shipdate), month(l_shipdate), day(l_shipdate), CASE WHEN hh = 24 THEN 0 ELSE hh END, mi, 0) AS ts_same_day
FROM k""",
    "clock_shift_bucket": """SELECT event_id, ts + INTERVAL 2 HOUR AS ts_plus2, strftime(ts, '%Y-%m-%d %H') AS hour_label,
  strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%d %H') AS hour_label_plus2, date_trunc('hour', ts) AS hour_start FROM events""",
    "minutes_signed": _gap_sql(False),
    "minutes_wrapped": _gap_sql(True),
    "local_to_utc": f"""WITH {ZONES},
z AS (SELECT o_orderkey, o_orderdate, coalesce(nz.tt_tz, rz.state_tz) AS tz
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN rz ON n_regionkey = rz.state LEFT JOIN nz ON n_name = nz.tt_city)
SELECT o_orderkey, tz, o_orderdate, timezone('UTC', timezone(tz, o_orderdate)) AS utc_ts FROM z""",
    "day_block": f"SELECT event_id, {DAY_BLOCK} AS block FROM events",
    "indicator_flags": """SELECT o_orderkey, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS f_urgent,
  CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS f_high, CAST(o_orderpriority = '5-LOW' AS INTEGER) AS f_low,
  coalesce(CAST(nullif(o_custkey % 5, 4) = 0 AS INTEGER), 0) AS f_zero FROM orders""",
    "haversine_pairs": f"WITH {NATION_PTS} SELECT n_nationkey, s_suppkey, (floor((dist) * 1000000.0 + 0.5) / 1000000.0) AS distance_km FROM pairs WHERE dist < 60",
    "nearest_three": f"""WITH {NATION_PTS},
r AS (SELECT n_nationkey, s_suppkey, dist,
        CAST(row_number() OVER (PARTITION BY n_nationkey ORDER BY (floor((dist) * 1000000.0 + 0.5) / 1000000.0), s_suppkey) AS INTEGER) AS rank
      FROM pairs WHERE dist < 30)
SELECT n_nationkey, s_suppkey, (floor((dist) * 1000000.0 + 0.5) / 1000000.0) AS distance_km, rank FROM r WHERE rank <= 3""",
    "previous_event_one": """SELECT event_id, user_id, prev_event_id, prev_ts, prev_value FROM (
  SELECT event_id, user_id, lag(event_id) OVER w AS prev_event_id, lag(ts) OVER w AS prev_ts, lag(value) OVER w AS prev_value
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) x WHERE prev_event_id IS NOT NULL""",
    "previous_event_all": """WITH t AS (SELECT l_suppkey, l_shipdate, lag(l_shipdate) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate) AS before
  FROM (SELECT DISTINCT l_suppkey, l_shipdate FROM lineitem) d)
SELECT a.l_orderkey, a.l_linenumber, a.l_suppkey, a.l_shipdate, p.l_orderkey AS prev_l_orderkey,
  p.l_linenumber AS prev_l_linenumber, p.l_quantity AS prev_l_quantity
FROM t JOIN lineitem a ON a.l_suppkey = t.l_suppkey AND a.l_shipdate = t.l_shipdate
JOIN lineitem p ON p.l_suppkey = t.l_suppkey AND p.l_shipdate = t.before""",
    "hourly_rate": f"""WITH {FLIGHTS} SELECT event_type, date_trunc('hour', ts + INTERVAL 2 HOUR) AS hour_bucket, count(*) AS n,
  CAST(sum(delayed) AS BIGINT) AS n_delayed, (floor((CAST(sum(CAST(value AS DECIMAL(38,2))) AS DOUBLE) / count(value)) * 1000000.0 + 0.5) / 1000000.0) AS mean_value, (floor((sum(delayed) / count(*)) * 1000000.0 + 0.5) / 1000000.0) AS rate
FROM ev GROUP BY ALL""",
    "lagged_rate": f"""WITH {FLIGHTS},
rate AS (SELECT event_type, date_trunc('hour', ts + INTERVAL 2 HOUR) AS hb, count(*) AS hourly_n,
         CAST(sum(delayed) AS BIGINT) AS hourly_delayed, sum(delayed) / count(*) AS hourly_rate, CAST(sum(CAST(value AS DECIMAL(38,2))) AS DOUBLE) / count(value) AS hourly_mean
         FROM ev GROUP BY ALL)
SELECT e.event_id, r.hourly_n, r.hourly_delayed, (floor((r.hourly_rate) * 1000000.0 + 0.5) / 1000000.0) AS hourly_rate, (floor((r.hourly_mean) * 1000000.0 + 0.5) / 1000000.0) AS hourly_mean
FROM ev e LEFT JOIN rate r ON e.event_type = r.event_type AND date_trunc('hour', e.ts) = r.hb""",
    "dim_inner": "SELECT c_custkey, c_nationkey AS n_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "interval_match": f"WITH {MATCHES} SELECT event_id, r_event_id, r_value FROM m",
    "interval_summary": f"""WITH {MATCHES},
mv AS (SELECT event_id, CAST(sum(CAST(r_value AS DECIMAL(38,2))) AS DOUBLE) / count(r_value) AS mean_value FROM m GROUP BY event_id),
cnt AS (SELECT event_id, r_cat, count(*) AS c FROM m GROUP BY ALL),
md AS (SELECT event_id, r_cat AS mode_cat FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY c DESC, r_cat) AS rn FROM cnt) x WHERE rn = 1)
SELECT e.event_id, (floor((mv.mean_value) * 1000000.0 + 0.5) / 1000000.0) AS mean_value, md.mode_cat
FROM events e LEFT JOIN mv ON e.event_id = mv.event_id LEFT JOIN md ON e.event_id = md.event_id""",
    "group_median": f"""WITH {GAPS} SELECT event_type, block, (floor((quantile_cont(value, 0.5)) * 1000000.0 + 0.5) / 1000000.0) AS median_value
FROM gp GROUP BY event_type, block""",
    "impute_by_group": f"""WITH {GAPS},
md AS (SELECT event_type, block, quantile_cont(value, 0.5) AS m FROM gp GROUP BY event_type, block)
SELECT gp.event_id, (floor((coalesce(gp.value, md.m)) * 1000000.0 + 0.5) / 1000000.0) AS value_imp
FROM gp LEFT JOIN md ON gp.event_type IS NOT DISTINCT FROM md.event_type AND gp.block = md.block""",
    "mode_by_group": """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY ALL)
SELECT user_id, event_type AS mode_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM c) x WHERE rn = 1""",
    "distinct_pairs": "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem",
    "class_weights": f"""WITH {SCORED},
r AS (SELECT CAST(count_if(label = 0) AS BIGINT) / count(*) AS ratio FROM s)
SELECT label, count(*) AS n_rows, (floor((max(CASE WHEN label = 1 THEN r.ratio ELSE 1 - r.ratio END)) * 1000000.0 + 0.5) / 1000000.0) AS weight
FROM s CROSS JOIN r GROUP BY label""",
    "missing_profile": _missing_sql(),
    "tail_bounds": """SELECT 'neg' AS side, CAST(0.01 AS DOUBLE) AS prob, (floor((quantile_cont(value - 50, 0.01)) * 1000000.0 + 0.5) / 1000000.0) AS bound
  FROM events WHERE value - 50 < 0 AND event_id % 11 <> 0
UNION ALL SELECT 'pos', CAST(0.99 AS DOUBLE), (floor((quantile_cont(value - 50, 0.99)) * 1000000.0 + 0.5) / 1000000.0) FROM events WHERE value - 50 > 0 AND event_id % 11 <> 0""",
    "measure_summary": _describe_sql(["l_quantity", "l_discount", "l_tax"]),
    "histogram": """SELECT CASE WHEN value < CAST(0.0 AS DOUBLE) THEN 0 WHEN value >= CAST(400.0 AS DOUBLE) THEN 21
  ELSE CAST(floor(20 * (value - CAST(0.0 AS DOUBLE)) / (CAST(400.0 AS DOUBLE) - CAST(0.0 AS DOUBLE))) AS BIGINT) + 1 END AS bucket,
  count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1""",
    "mean_by_calendar": """SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n,
  (floor((CAST(sum(CAST(value AS DECIMAL(38,2))) AS DOUBLE) / count(value)) * 1000000.0 + 0.5) / 1000000.0) AS mean_value FROM events GROUP BY ALL""",
    "rate_by_group": f"""WITH {FLIGHTS} SELECT event_type, count(*) AS n, CAST(sum(delayed) AS BIGINT) AS n_flagged,
  (floor((avg(CAST(delayed AS DOUBLE))) * 1000000.0 + 0.5) / 1000000.0) AS rate FROM ev GROUP BY event_type""",
    "conditional_rate": f"""WITH {FLIGHTS},
p AS (SELECT delayed, lag(delayed) OVER w AS prev_delayed, lag(event_id) OVER w AS pe
      FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT prev_delayed, count(*) AS n, CAST(sum(delayed) AS BIGINT) AS n_flagged, (floor((avg(CAST(delayed AS DOUBLE))) * 1000000.0 + 0.5) / 1000000.0) AS rate
FROM p WHERE pe IS NOT NULL GROUP BY prev_delayed""",
    "box_summary": _quantile_union("(SELECT CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type, value FROM events WHERE event_id % 11 <> 0)", "value", [0.0, 0.25, 0.5, 0.75, 1.0], "event_type", "value"),
    "correlation_matrix": _corr_sql(["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
    "category_share": """SELECT l_returnflag, l_linestatus, count(*) AS n,
  (floor((count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag)) * 1000000.0 + 0.5) / 1000000.0) AS share FROM lineitem GROUP BY 1, 2""",
    "audit_unique": """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(count_if(n > 1) AS BIGINT) AS n_dup_keys,
  CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS n_rows_in_dups FROM k""",
    "exclusion_ledger": _ledger_sql(),
    "gini_by_feature": _gini_sql(),
    "sort_top_n": "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 20",
    "confusion": f"WITH {SCORED} SELECT label, prediction, count(*) AS n FROM s2 GROUP BY ALL",
    "class_metrics": f"WITH {SCORED} " + _metrics("s2"),
    "average_precision": f"""WITH {SCORED}, {CUM}
SELECT (floor((sum(tp / P * (cum_tp / (cum_tp + cum_fp)))) * 1000000.0 + 0.5) / 1000000.0) AS average_precision FROM c""",
    "roc_curve": f"""WITH {SCORED}, {CUM}
SELECT score, (floor((cum_fp / N) * 1000000.0 + 0.5) / 1000000.0) AS fpr, (floor((cum_tp / P) * 1000000.0 + 0.5) / 1000000.0) AS tpr FROM c
UNION ALL SELECT NULL, 0.0, 0.0 UNION ALL SELECT NULL, 1.0, 1.0""",
    "roc_auc": f"""WITH {SCORED}, {CUM}
SELECT (floor((sum((fp / N) * ((cum_tp / P) + ((cum_tp - tp) / P)) / 2)) * 1000000.0 + 0.5) / 1000000.0) AS roc_auc FROM c""",
    "pr_curve": f"""WITH {SCORED}, {CUM}
SELECT score, (floor((cum_tp / (cum_tp + cum_fp)) * 1000000.0 + 0.5) / 1000000.0) AS precision, (floor((cum_tp / P) * 1000000.0 + 0.5) / 1000000.0) AS recall FROM c
UNION ALL SELECT NULL, 1.0, 0.0""",
    "model_compare": f"""WITH {SCORED}, s3 AS (SELECT label, CAST(score > 0.4 AS INTEGER) AS prediction FROM s)
{_metrics("s3", "cut_0.4")} UNION ALL {_metrics("s2", "cut_0.6")}""",
    "hash_split": f"SELECT event_id, ({_hex8(chr(39) + '7:' + chr(39) + ' || CAST(event_id AS VARCHAR)')} % 100) < 80 AS is_train FROM events",
    "hash_subsample": f"SELECT event_id FROM events WHERE ({_hex8(chr(39) + '7:' + chr(39) + ' || CAST(event_id AS VARCHAR)')} % 1000000) < 300000",
    "index_categories": _index_sql() + """
SELECT l.l_orderkey, l.l_linenumber, rf.rf_idx, ls.ls_idx FROM lineitem l
JOIN rf ON l.l_returnflag = rf.l_returnflag JOIN ls ON l.l_linestatus = ls.l_linestatus""",
    "onehot_features": _index_sql() + """
SELECT l.l_orderkey, l.l_linenumber,
  CAST(rf.rf_idx = 0 AS DOUBLE) AS f0, CAST(rf.rf_idx = 1 AS DOUBLE) AS f1, CAST(rf.rf_idx = 2 AS DOUBLE) AS f2,
  CAST(ls.ls_idx = 0 AS DOUBLE) AS f3, CAST(ls.ls_idx = 1 AS DOUBLE) AS f4,
  l.l_quantity + 0.0 AS f5, l.l_discount + 0.0 AS f6
FROM lineitem l JOIN rf ON l.l_returnflag = rf.l_returnflag JOIN ls ON l.l_linestatus = ls.l_linestatus""",
}


def _study_sql() -> str:
    """The whole ETL in SQL: lag for the predecessor, a cross join + row_number for the nearest
    stations, a range join for the readings, quantile_cont for the medians."""
    from aloft.plans.bindings import STUDY_CITY_ZONES, STUDY_STATE_ZONES
    prev = ("FLIGHT_IDX CRS_DEP_LOCAL DEP_LOCAL DEP_DELAY DEP_DELAY_NEW DEP_DEL15 CRS_ELAPSED_TIME CRS_ARR_LOCAL ARR_LOCAL "
            "ARR_DELAY ARR_DELAY_NEW ARR_DEL15").split()
    same = ("FLIGHT_IDX QUARTER MONTH DAY_OF_WEEK FL_DATE CRS_DEP_TIME DEP_TIME_BLK CRS_DEP_UTC OP_UNIQUE_CARRIER TAIL_NUM ORIGIN "
            "ORIGIN_CITY_NAME ORIGIN_TIMEZONE AIRPORT_LATITUDE AIRPORT_LONGITUDE AIRPORT_ALTITUDE DEST DEST_CITY_NAME CRS_ELAPSED_TIME "
            "DEP_DELAY DEP_DELAY_NEW DEP_DEL15 PREV_DEP_TO_CURR_CRSDEP PREP_TIME HOURLY_NUM_OF_FLIGHTS HOURLY_NUM_OF_DELAY CloudMode "
            "AtmCondition CloudMode_binary BLOCK6 BLOCK7 BLOCK0 BLOCK8").split() + [f"PREV_{c}" for c in prev]
    rounded = ("HOURLY_DELAY_RATE WindAngle SeaLevelPressure WindSpeed_imp VerticalVisibility_imp Visibility_imp Temperature_imp "
               "DewPointTemp_imp CloudHeight_imp").split()
    needed = ("ORIGIN FL_DATE MONTH DAY_OF_WEEK DEP_TIME_BLK AIRPORT_ALTITUDE PREP_TIME PREV_DEP_DEL15 PREV_CRS_ELAPSED_TIME PREV_ARR_DEL15 "
              "WindSpeed_imp VerticalVisibility_imp Visibility_imp Temperature_imp DewPointTemp_imp DEP_DELAY_NEW DEP_DEL15").split()
    blocks = [("BLOCK6", "0600-0659"), ("BLOCK7", "0700-0759"), ("BLOCK0", "0001-0559"), ("BLOCK8", "0800-0859")]
    local = lambda t: (f"date_trunc('day', ts) + to_minutes(CAST(CASE WHEN hour({t}) * 60 + minute({t}) = 0 THEN 1440 "  # noqa: E731
                       f"ELSE hour({t}) * 60 + minute({t}) END AS BIGINT))")
    md5i = lambda e, m: f"(CAST(('0x' || substr(md5({e}), 1, 6)) AS BIGINT) % {m})"
    exact1 = lambda c: f"CAST(sum(CAST({c} AS DECIMAL(38,1))) AS DOUBLE) / count({c})"
    fields = ["WindAngle", "WindSpeed", "VerticalVisibility", "Visibility", "Temperature", "DewPointTemp",
              "SeaLevelPressure", "CloudHeight", "CloudMode", "AtmCondition"]
    numeric = fields[:8]
    blk = lambda t: (f"strftime({t} - INTERVAL 150 MINUTE, '%Y-%m-%d') || ' ' || CASE WHEN hour({t} - INTERVAL 150 MINUTE) < 6 "
                     f"THEN 'early' WHEN hour({t} - INTERVAL 150 MINUTE) < 12 THEN 'morning' "
                     f"WHEN hour({t} - INTERVAL 150 MINUTE) < 18 THEN 'afternoon' ELSE 'night' END")
    imp = ["WindSpeed", "VerticalVisibility", "Visibility", "Temperature", "DewPointTemp", "CloudHeight"]
    return f"""WITH {OBS},
raw AS (SELECT event_id AS FLIGHT_IDX, ts, user_id, event_type, CAST(floor(value) AS BIGINT) AS late, 10 + (event_id * 7) % 150 AS elapsed FROM events),
c4 AS (SELECT *, ts + to_minutes(late - 20) AS dep_t, ts + to_minutes(elapsed) AS carr_t, ts + to_minutes(elapsed + late) AS arr_t FROM raw),
-- a clock is the scheduled date with the clock's hour and minute; midnight (2400) is the next day's
fl AS (SELECT FLIGHT_IDX, quarter(ts) AS QUARTER, month(ts) AS MONTH, isodow(ts) AS DAY_OF_WEEK, strftime(ts, '%Y-%m-%d') AS FL_DATE,
         'C' || (user_id % 7) AS OP_UNIQUE_CARRIER, CASE WHEN FLIGHT_IDX % 40 <> 0 THEN 'N' || user_id END AS TAIL_NUM, event_type AS ORIGIN,
         'City ' || event_type AS ORIGIN_CITY_NAME, 'S0' || CAST({md5i('event_type', 5)} AS VARCHAR) AS ST, 'D' || (FLIGHT_IDX % 5) AS DEST,
         'Town ' || (FLIGHT_IDX % 5) AS DEST_CITY_NAME, CASE WHEN strftime(ts, '%H%M') = '0000' THEN '2400' ELSE strftime(ts, '%H%M') END AS CRS_DEP_TIME,
         {local('ts')} AS CRS_DEP_LOCAL, {local('dep_t')} AS DEP_LOCAL, {local('carr_t')} AS CRS_ARR_LOCAL, {local('arr_t')} AS ARR_LOCAL,
         CASE WHEN FLIGHT_IDX % 41 <> 0 THEN CAST(late - 20 AS DOUBLE) END AS DEP_DELAY, CAST(greatest(late - 20, 0) AS DOUBLE) AS DEP_DELAY_NEW,
         CAST(late - 20 >= 60 AS INTEGER) AS DEP_DEL15, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || '00-' || lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || '59' AS DEP_TIME_BLK,
         CAST(elapsed AS DOUBLE) AS CRS_ELAPSED_TIME, CAST(late * 2 - 85 - FLIGHT_IDX % 9 AS DOUBLE) AS ARR_DELAY,
         CAST(greatest(late * 2 - 85 - FLIGHT_IDX % 9, 0) AS DOUBLE) AS ARR_DELAY_NEW,
         CASE WHEN FLIGHT_IDX % 43 <> 0 THEN CAST(late * 2 - 85 - FLIGHT_IDX % 9 >= 60 AS INTEGER) END AS ARR_DEL15
       FROM c4 WHERE FLIGHT_IDX % 30 <> 0 AND FLIGHT_IDX % 37 <> 0),
pv AS (SELECT *, {", ".join(f"lag({c}) OVER w AS PREV_{c}" for c in prev)}
       FROM fl WHERE TAIL_NUM IS NOT NULL
       WINDOW w AS (PARTITION BY TAIL_NUM ORDER BY CRS_DEP_LOCAL, DEP_LOCAL, CRS_ARR_LOCAL, ARR_LOCAL, FLIGHT_IDX)),
pv2 AS (SELECT *, CAST((epoch_us(CRS_DEP_LOCAL) - epoch_us(PREV_DEP_LOCAL)) // 60000000 AS INTEGER) AS PREV_DEP_TO_CURR_CRSDEP
        FROM pv WHERE PREV_FLIGHT_IDX IS NOT NULL),
hr AS (SELECT ORIGIN, date_trunc('hour', CRS_DEP_LOCAL + INTERVAL 2 HOUR) AS HB, count(*) AS HOURLY_NUM_OF_FLIGHTS,
         CAST(sum(DEP_DEL15) AS BIGINT) AS HOURLY_NUM_OF_DELAY, sum(DEP_DEL15) / count(*) AS HOURLY_DELAY_RATE FROM fl GROUP BY ALL),
pl AS (SELECT event_type AS IATA, CASE WHEN event_type <> 'signup' THEN CAST(40.06 AS DOUBLE) + {md5i('event_type', 10)} * CAST(0.23 AS DOUBLE) END AS PLAT,
         CAST(-99.97 AS DOUBLE) AS PLON, CASE WHEN event_type <> 'error' THEN CAST(120 AS DOUBLE) END AS ALT FROM (SELECT DISTINCT event_type FROM events) e),
tz(state, zone) AS (VALUES {_values(STUDY_STATE_ZONES)}),
cz(city, czone) AS (VALUES {_values(STUDY_CITY_ZONES)}),
f0 AS (SELECT p.*, PREV_DEP_TO_CURR_CRSDEP - PREV_CRS_ELAPSED_TIME AS PREP_TIME, h.HOURLY_NUM_OF_FLIGHTS, h.HOURLY_NUM_OF_DELAY, h.HOURLY_DELAY_RATE,
        PLAT AS AIRPORT_LATITUDE, PLON AS AIRPORT_LONGITUDE, ALT AS AIRPORT_ALTITUDE, coalesce(czone, zone) AS ORIGIN_TIMEZONE
      FROM pv2 p JOIN pl ON p.ORIGIN = pl.IATA
      LEFT JOIN hr h ON p.ORIGIN = h.ORIGIN AND date_trunc('hour', p.CRS_DEP_LOCAL) = h.HB
      LEFT JOIN tz ON p.ST = tz.state LEFT JOIN cz ON p.ORIGIN_CITY_NAME = cz.city),
f AS (SELECT *, timezone('UTC', timezone(ORIGIN_TIMEZONE, CRS_DEP_LOCAL)) AS CRS_DEP_UTC FROM f0),
w AS (SELECT l_suppkey AS STATION, CAST(40.01 AS DOUBLE) + (l_suppkey % 10) * CAST(0.23 AS DOUBLE) AS SLAT,
        CAST(-100.02 AS DOUBLE) + (floor(l_suppkey / 10) % 10) * CAST(0.24 AS DOUBLE) AS SLON,
        TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((l_orderkey * 37 + l_linenumber * 11) % 43200 AS BIGINT)) AS RTS,
        {", ".join(_field(n) for n in fields)}
      FROM obs2),
st AS (SELECT STATION, min(SLAT) AS SLAT, min(SLON) AS SLON FROM w GROUP BY STATION),
pairs AS (SELECT IATA, STATION, CAST(6371.0 AS DOUBLE) * (2 * atan2(sqrt(a), sqrt(1 - a))) AS d FROM (
          SELECT IATA, STATION, sin(radians(SLAT - PLAT) / 2) * sin(radians(SLAT - PLAT) / 2)
            + cos(radians(PLAT)) * cos(radians(SLAT)) * sin(radians(SLON - PLON) / 2) * sin(radians(SLON - PLON) / 2) AS a
          FROM pl CROSS JOIN st WHERE PLAT IS NOT NULL) y),
near AS (SELECT IATA, STATION FROM (SELECT *, row_number() OVER (PARTITION BY IATA ORDER BY round(d, 6), STATION) AS rn
         FROM pairs WHERE d < 30) z WHERE rn <= 3),
m AS (SELECT f.FLIGHT_IDX, w.* FROM f JOIN near ON f.ORIGIN = near.IATA JOIN w ON w.STATION = near.STATION
        AND w.RTS > f.CRS_DEP_UTC - INTERVAL 3 HOUR AND w.RTS < f.CRS_DEP_UTC - INTERVAL 2 HOUR),
mm AS (SELECT FLIGHT_IDX, {", ".join(f"{exact1(c)} AS {c}" for c in numeric)} FROM m GROUP BY FLIGHT_IDX),
cm AS (SELECT FLIGHT_IDX, CloudMode FROM (SELECT FLIGHT_IDX, CloudMode, row_number() OVER (PARTITION BY FLIGHT_IDX ORDER BY count(*) DESC, CloudMode) AS rn
         FROM m WHERE CloudMode IS NOT NULL GROUP BY FLIGHT_IDX, CloudMode) q WHERE rn = 1),
am AS (SELECT FLIGHT_IDX, AtmCondition FROM (SELECT FLIGHT_IDX, AtmCondition, row_number() OVER (PARTITION BY FLIGHT_IDX ORDER BY count(*) DESC, AtmCondition) AS rn
         FROM m WHERE AtmCondition IS NOT NULL GROUP BY FLIGHT_IDX, AtmCondition) q WHERE rn = 1),
j AS (SELECT f.*, {", ".join(f"mm.{c}" for c in numeric)}, cm.CloudMode, am.AtmCondition, {blk("f.CRS_DEP_UTC")} AS WB
      FROM f LEFT JOIN mm ON f.FLIGHT_IDX = mm.FLIGHT_IDX LEFT JOIN cm ON f.FLIGHT_IDX = cm.FLIGHT_IDX LEFT JOIN am ON f.FLIGHT_IDX = am.FLIGHT_IDX),
md AS (SELECT ORIGIN, WB, {", ".join(f"quantile_cont({c}, 0.5) AS {c}_md" for c in imp)} FROM j GROUP BY ORIGIN, WB),
fin AS (SELECT j.* EXCLUDE (HOURLY_DELAY_RATE, HOURLY_NUM_OF_FLIGHTS), coalesce(HOURLY_DELAY_RATE, 0) AS HOURLY_DELAY_RATE,
          coalesce(HOURLY_NUM_OF_FLIGHTS, 0) AS HOURLY_NUM_OF_FLIGHTS, {", ".join(f"coalesce(j.{c}, md.{c}_md) AS {c}_imp" for c in imp)},
          coalesce(CAST(j.CloudMode = 0 AS INTEGER), 0) AS CloudMode_binary, {", ".join(f"CAST(DEP_TIME_BLK = '{v}' AS INTEGER) AS {k}" for k, v in blocks)}
        FROM j LEFT JOIN md ON j.ORIGIN = md.ORIGIN AND j.WB IS NOT DISTINCT FROM md.WB)
SELECT {", ".join(same)}, {", ".join(f"(floor(({c}) * 1000000.0 + 0.5) / 1000000.0) AS {c}" for c in rounded)} FROM fin
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in needed)}
  AND PREV_CRS_ELAPSED_TIME > 18 AND CRS_ELAPSED_TIME > 18 AND PREV_DEP_DELAY > -45 AND PREV_DEP_DELAY < 1609
  AND PREV_ARR_DELAY > -81 AND PREV_ARR_DELAY < 1605 AND DEP_DELAY > -45 AND DEP_DELAY < 1609"""


ORACLE["study_features"] = _study_sql()
ORACLE["dense_pairs"] = ORACLE["haversine_pairs"]
ORACLE["previous_event_number"] = """SELECT * FROM (SELECT o_orderkey, o_custkey, lag(o_orderkey) OVER w AS prev_o_orderkey, lag(o_totalprice) OVER w AS prev_o_totalprice
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)) x WHERE prev_o_orderkey IS NOT NULL"""
ORACLE["rate_sink_restart"] = f"""SELECT *, strftime(hour_bucket, '%Y-%m-%d') AS day FROM ({ORACLE["hourly_rate"]}) q WHERE day(hour_bucket) <= 10"""


# ---------------------------------------------------------------- models: what a fit on one category must come to
_MODEL = f"""d AS (SELECT l_orderkey, l_linenumber, 'k' || (l_linenumber % 3) AS kind, CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE 1 END AS leaf,
  CAST(l_discount >= CASE WHEN l_linenumber % 3 = 0 THEN CAST(0.02 AS DOUBLE) ELSE CAST(0.08 AS DOUBLE) END AS INTEGER) AS label,
  {_hex8("'7:' || l_orderkey || ':' || l_linenumber")} AS h FROM lineitem)"""


def _shares(where: str, by: str) -> str:
    """Weighted share of positives of the train rows: positives weigh the share of negatives, negatives the rest.
    By category (logistic regression), or by the categories that a tree predicts alike (``leaf``)."""
    return f"""r AS (SELECT count_if(label = 0) / count(*) AS r FROM d WHERE h % 100 < 80 AND {where}),
sh AS (SELECT {by}, sum(CASE WHEN label = 1 THEN r ELSE 0 END) / sum(CASE WHEN label = 1 THEN r ELSE 1 - r END) AS p
       FROM d CROSS JOIN r WHERE h % 100 < 80 AND {where} GROUP BY {by})"""


def _model_sql(threshold: float, decimals: int, by: str, more: str = "") -> str:
    k = f"1{'0' * decimals}.0"
    return f"""WITH {_MODEL}, {_shares("TRUE", by)}
SELECT l_orderkey, l_linenumber, label, CAST(p > {threshold} AS INTEGER) AS prediction, floor(p * {k} + 0.5) / {k} AS score{more}
FROM d JOIN sh USING ({by}) WHERE h % 100 >= 80"""


def _fold_sql() -> str:
    """Metrics of each fold by the weighted shares of the other folds' train rows (class weights of the whole train side)."""
    base = f"""WITH {_MODEL}, f AS (SELECT *, {_hex8("'8:' || l_orderkey || ':' || l_linenumber")} % 3 AS fold FROM d WHERE h % 100 < 80),
r AS (SELECT count_if(label = 0) / count(*) AS r FROM f)"""
    parts = []
    for fold in range(3):
        parts.append(f"""SELECT {fold} AS fold, q.* FROM ({base},
sh AS (SELECT kind, sum(CASE WHEN label = 1 THEN r ELSE 0 END) / sum(CASE WHEN label = 1 THEN r ELSE 1 - r END) AS p FROM f CROSS JOIN r WHERE fold <> {fold} GROUP BY kind),
t AS (SELECT label, CAST(p > 0.6 AS INTEGER) AS prediction FROM f JOIN sh USING (kind) WHERE fold = {fold})
{_metrics("t")}) q""")
    return " UNION ALL ".join(parts)


def _fractions_sql() -> str:
    """Rows per fraction and side of the study's table, by the key's hash."""
    h = _hex8("'7:' || FLIGHT_IDX")
    parts = [f"""SELECT CAST({frac} AS DOUBLE) AS fraction, CASE WHEN h % 100 < 80 THEN 'train' ELSE 'test' END AS side, count(*) AS n,
CAST(sum(y) AS BIGINT) AS n_positive FROM t WHERE h % 1000000 < {bound} GROUP BY ALL""" for frac, bound in ((1.0, 1_000_000), (0.5, 500_000), (0.25, 250_000))]
    return f"WITH t AS (SELECT {h} AS h, DEP_DEL15 AS y FROM ({_study_sql()}) q) " + " UNION ALL ".join(parts)


def _study_corr_sql() -> str:
    """corr() of every pair of the study table's numeric columns."""
    from aloft.plans.flight_study import NUMERIC
    pairs = [(a, c) for i, a in enumerate(NUMERIC) for c in NUMERIC[i:]]
    rows = ", ".join(f"{{'col_a': '{a}', 'col_b': '{c}', 'corr': floor(corr(CAST({a} AS DOUBLE), CAST({c} AS DOUBLE)) * 1000000.0 + 0.5) / 1000000.0}}" for a, c in pairs)
    return f"SELECT unnest([{rows}], recursive := true) FROM ({_study_sql()}) q"


def _curve_sql() -> str:
    parts = []
    for frac, bound in ((1.0, 1_000_000), (0.5, 500_000), (0.25, 250_000)):
        where = f"h % 1000000 < {bound}"
        parts.append(f"""SELECT CAST({frac} AS DOUBLE) AS fraction, tp + fp + tn + fn AS n_test, f1_macro, accuracy FROM (
WITH {_MODEL}, {_shares(where, "leaf")}, t AS (SELECT label, CAST(p > 0.5 AS INTEGER) AS prediction FROM d JOIN sh USING (leaf) WHERE h % 100 >= 80 AND {where})
{_metrics("t")}) q""")
    return " UNION ALL ".join(parts)


ORACLE |= {
    "logistic_scores": _model_sql(0.5, 3, "kind"),
    "logistic_threshold": _model_sql(0.6, 3, "kind"),
    "logistic_tuned": _model_sql(0.6, 3, "kind", ", CAST(0.0 AS DOUBLE) AS reg_param, 100 AS max_iter"),
    "forest_scores": _model_sql(0.5, 6, "leaf"),
    "forest_selected": _model_sql(0.5, 6, "leaf"),
    # slots in order of frequency (ties by name), then the one for unseen kinds and the constant; the first kind tells all
    "forest_importance": f"""WITH {_MODEL},
c AS (SELECT kind, row_number() OVER (ORDER BY count(*) DESC, kind) - 1 AS idx FROM d WHERE h % 100 < 80 GROUP BY kind)
SELECT 'kind_indexed_classVec_' || kind AS name, CAST(idx AS INTEGER) AS idx, kind = 'k0' AS selected, CAST(100 AS DOUBLE) AS total FROM c
UNION ALL SELECT 'kind_indexed_classVec___unknown', 3, FALSE, 100.0 UNION ALL SELECT 'flat', 4, FALSE, 100.0""",
    "learning_curve": _curve_sql(),
    "logistic_fold_scores": _fold_sql(),
    "study_fraction_rows": _fractions_sql(),
    "study_correlation": _study_corr_sql(),
}
