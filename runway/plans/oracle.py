"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark code, from the same definitions: the
stand-in views (``legs``, ``reports``, ``stations``), then the operator in
plain SQL.  Spark and DuckDB differ in a few places, handled here:

* ``||`` (NULL if any part is NULL) plays Spark's ``concat``; DuckDB's
  ``concat`` skips NULLs.
* DuckDB lists are 1-based; Spark's ``get(split(...), 0)`` is ``[1]`` here.
* DuckDB rounds on double -> int casts; Spark truncates: use ``trunc``/``floor``.
* ``'... 24:00'`` casts to the next day in DuckDB; ``try_strptime`` gives NULL as
  Spark's ``try_cast`` does.
* DuckDB sorts NULLs last by default; windows spell out ``NULLS FIRST``.
* Sums and means of doubles are rounded to 9 and then 6 places on both sides,
  since their last bits depend on the order of summation (``_mean``).
"""

from __future__ import annotations

from runway.params import FLIGHT_COLUMNS as FLIGHT_NAMES
from runway.params import WEATHER_COLUMNS
from runway.plans.catalog import HUBS

AIRPORT = "NATION_3"
OTHER_AIRPORT = "NATION_7"
LO, END, INF = "2024-01-01", "2024-01-30", "2024-01-31"
SPAN_LO, SPAN_HI = "2024-01-10", "2024-01-20"

HOURLY = ["avg_temp_f", "tot_precip_mm", "avg_wnd_mps", "avg_vis_m", "avg_slp_hpa", "avg_dewpt_f"]


def _block(hh: str) -> str:
    return (f"CASE WHEN {hh} < 6 THEN '0001-0559' ELSE lpad(CAST({hh} AS VARCHAR), 2, '0') || '00-' "
            f"|| lpad(CAST({hh} AS VARCHAR), 2, '0') || '59' END")


def _city(nk: str, region: str) -> str:
    return (f"'Port ' || CAST({nk} AS VARCHAR) || CASE WHEN {nk} % 4 = 0 THEN ' City' ELSE '' END "
            f"|| ', ' || substr({region}, 1, 2)")


LEGS_RAW = f"""
legs_src AS (
  SELECT l.*, o.o_orderdate, o.o_orderpriority,
         n1.n_nationkey AS o_nk, n1.n_name AS o_name, r1.r_name AS o_region,
         n2.n_nationkey AS d_nk, n2.n_name AS d_name, r2.r_name AS d_region,
         DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) % 30 AS INTEGER) AS fd,
         CAST(l.l_partkey % 24 AS INTEGER) AS dep_hh,
         CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS DOUBLE) AS dep_delay,
         CASE WHEN (l.l_partkey + l.l_suppkey) % 50 = 0 THEN 2400
              ELSE CAST(((l.l_partkey + l.l_linenumber * 3) % 24) * 100 + (l.l_suppkey * 7) % 60 AS INTEGER) END AS crs_arr
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n1 ON s.s_nationkey = n1.n_nationkey
  JOIN region r1 ON n1.n_regionkey = r1.r_regionkey
  JOIN nation n2 ON c.c_nationkey = n2.n_nationkey
  JOIN region r2 ON n2.n_regionkey = r2.r_regionkey
),
legs AS (
  SELECT
    CAST(year(fd) AS INTEGER) AS "YEAR",
    CAST(quarter(fd) AS INTEGER) AS "QUARTER",
    CAST(month(fd) AS INTEGER) AS "MONTH",
    CAST(day(fd) AS INTEGER) AS DAY_OF_MONTH,
    CAST(isodow(fd) AS INTEGER) AS DAY_OF_WEEK,
    fd AS FL_DATE,
    substr(o_orderpriority, 3, 2) AS OP_UNIQUE_CARRIER,
    substr(o_orderpriority, 3, 2) AS OP_CARRIER,
    CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE 'N' || CAST(l_suppkey AS VARCHAR) END AS TAIL_NUM,
    CAST(l_partkey AS INTEGER) AS OP_CARRIER_FL_NUM,
    o_name AS ORIGIN,
    {_city('o_nk', 'o_region')} AS ORIGIN_CITY_NAME,
    substr(o_region, 1, 2) AS ORIGIN_STATE_ABR,
    d_name AS DEST,
    {_city('d_nk', 'd_region')} AS DEST_CITY_NAME,
    substr(d_region, 1, 2) AS DEST_STATE_ABR,
    o_nk + 10000 AS ORIGIN_AIRPORT_ID,
    d_nk + 10000 AS DEST_AIRPORT_ID,
    l_orderkey AS ORIGIN_AIRPORT_SEQ_ID,
    CAST(dep_hh * 100 + CAST(trunc(l_quantity) AS INTEGER) % 60 AS INTEGER) AS CRS_DEP_TIME,
    {_block('dep_hh')} AS DEP_TIME_BLK,
    dep_delay AS DEP_DELAY,
    greatest(dep_delay, 0.0::DOUBLE) AS DEP_DELAY_NEW,
    CASE WHEN dep_delay >= 15 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS DEP_DEL15,
    crs_arr AS CRS_ARR_TIME,
    CASE WHEN l_linenumber = 7 THEN ''
         ELSE {_block('CAST(least(floor(crs_arr / 100), 23) AS INTEGER)')} END AS ARR_TIME_BLK,
    dep_delay + l_quantity - 25.0::DOUBLE AS ARR_DELAY,
    greatest(dep_delay + l_quantity - 25.0::DOUBLE, 0.0::DOUBLE) AS ARR_DELAY_NEW,
    CASE WHEN l_linenumber = 6 THEN NULL
         WHEN dep_delay + l_quantity - 25.0::DOUBLE >= 15 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ARR_DEL15,
    CASE WHEN l_discount = 0.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS CANCELLED,
    CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 1.0::DOUBLE
         WHEN l_linenumber = 5 AND l_tax = 0.08 THEN NULL ELSE 0.0::DOUBLE END AS DIVERTED,
    l_quantity * 6.0::DOUBLE + 30.0::DOUBLE AS CRS_ELAPSED_TIME,
    l_extendedprice / 50.0::DOUBLE AS DISTANCE,
    CAST(floor(l_extendedprice / 12500.0::DOUBLE) AS INTEGER) + 1 AS DISTANCE_GROUP,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
      || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS LEG_ID
  FROM legs_src
)"""


def _signed(v: str) -> str:
    return (f"CASE WHEN {v} < 0 THEN '-' ELSE '+' END || lpad(CAST(abs({v}) AS VARCHAR), 4, '0') || ',1'")


REPORTS_RAW = f"""
rep_src AS (
  SELECT e.*, n.n_nationkey AS k, r.r_name,
         CAST(floor(e.value * 10) AS INTEGER) - 1000 AS t
  FROM events e
  JOIN nation n ON n.n_nationkey = e.user_id % 25
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
reports AS (
  SELECT
    '7' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS STATION,
    ts AS "DATE",
    CAST(k AS DOUBLE) + 30.0::DOUBLE AS LATITUDE,
    CAST(user_id AS DOUBLE) / 10.0::DOUBLE - 100.0::DOUBLE AS LONGITUDE,
    CASE WHEN user_id % 13 = 0 THEN 'PORT ' || CAST(k AS VARCHAR) || ' FIELD, ' || substr(r_name, 1, 2) || ' US'
         WHEN user_id % 11 = 0 THEN 'PORT ' || CAST(k AS VARCHAR) || ' AIRPORT, ' || substr(r_name, 1, 2) || ' CA'
         ELSE 'PORT ' || CAST(k AS VARCHAR) || ' AIRPORT, ' || substr(r_name, 1, 2) || ' US' END AS NAME,
    CASE WHEN event_type = 'signup' THEN 'FM-12' WHEN event_type = 'error' THEN 'FM-16'
         ELSE 'FM-15' END AS REPORT_TYPE,
    CASE WHEN k >= 20 THEN NULL
         WHEN user_id % 7 = 0 THEN 'KNATION_' || CAST(k AS VARCHAR) || ' '
         ELSE 'KNATION_' || CAST(k AS VARCHAR) END AS CALL_SIGN,
    CASE WHEN event_id % 17 = 0 THEN '+9999,9' ELSE {_signed('t')} END AS TMP,
    lpad(CAST((event_id * 7) % 360 AS VARCHAR), 3, '0') || ',1,N,'
      || lpad(CAST(CAST(floor(value) AS INTEGER) % 150 AS VARCHAR), 4, '0') || ',1' AS WND,
    '22000,1,9,N' AS CIG,
    lpad(CAST((event_id * 37) % 16000 AS VARCHAR), 6, '0') || ',1,N,1' AS VIS,
    {_signed('(t - 60)')} AS DEW,
    lpad(CAST(10000 + (event_id * 13) % 400 AS VARCHAR), 5, '0') || ',1' AS SLP,
    CASE WHEN event_id % 3 = 0 THEN NULL
         WHEN event_id % 29 = 0 THEN '01'
         ELSE lpad(CAST(event_id % 4 AS VARCHAR), 2, '0') || ','
              || lpad(CAST(CAST(floor(value) AS INTEGER) % 100 AS VARCHAR), 4, '0') || ',9,5' END AS AA1,
    NULL::VARCHAR AS AJ1, NULL::VARCHAR AS AT1, NULL::VARCHAR AS GA1, NULL::VARCHAR AS IA1,
    NULL::VARCHAR AS MA1, NULL::VARCHAR AS MD1, NULL::VARCHAR AS OC1,
    props AS REM
  FROM rep_src
),
stations AS (SELECT DISTINCT STATION, CALL_SIGN FROM reports)"""

REPORT_COLUMNS = ", ".join(f'"{c}"' for c in WEATHER_COLUMNS)


def _norm(source: str, name: str = "norm") -> str:
    """The flight transform over ``source`` (a CTE of raw legs)."""
    return f"""
{name}_typed AS (
  SELECT
    CAST("YEAR" AS VARCHAR) AS "YEAR", CAST("QUARTER" AS VARCHAR) AS "QUARTER",
    CAST("MONTH" AS VARCHAR) AS "MONTH", CAST(DAY_OF_MONTH AS VARCHAR) AS DAY_OF_MONTH,
    CAST(DAY_OF_WEEK AS VARCHAR) AS DAY_OF_WEEK, FL_DATE,
    ORIGIN || '-' || DEST AS FL_PATH,
    OP_UNIQUE_CARRIER, TAIL_NUM,
    OP_CARRIER || '_' || CAST(OP_CARRIER_FL_NUM AS VARCHAR) AS OP_CARRIER_FL_NUM,
    ORIGIN, ORIGIN_CITY_NAME, ORIGIN_STATE_ABR, DEST, DEST_CITY_NAME, DEST_STATE_ABR,
    CRS_DEP_TIME,
    CAST(round(CRS_DEP_TIME / 100) AS INTEGER) AS CRS_DEP_TIME_HOUR,
    TRY_CAST(substr(DEP_TIME_BLK, 1, 2) AS INTEGER) AS DEP_TIME_HOUR,
    DEP_DELAY_NEW, DEP_TIME_BLK,
    CRS_ARR_TIME,
    CAST(round(CRS_ARR_TIME / 100) AS INTEGER) AS CRS_ARR_TIME_HOUR,
    TRY_CAST(substr(ARR_TIME_BLK, 1, 2) AS INTEGER) AS ARR_TIME_HOUR,
    ARR_DELAY_NEW, ARR_TIME_BLK, DISTANCE,
    CAST(DISTANCE_GROUP AS VARCHAR) AS DISTANCE_GROUP,
    CAST(DEP_DEL15 AS VARCHAR) AS DEP_DEL15,
    CAST(ARR_DEL15 AS VARCHAR) AS ARR_DEL15,
    ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID,
    try_strptime(CAST(FL_DATE AS VARCHAR) || ' ' || substr(lpad(CAST(CRS_DEP_TIME AS VARCHAR), 4, '0'), 1, 2)
                 || ':' || substr(lpad(CAST(CRS_DEP_TIME AS VARCHAR), 4, '0'), 3, 2), '%Y-%m-%d %H:%M') AS CRS_DEP_TIMESTAMP,
    try_strptime(CAST(FL_DATE AS VARCHAR) || ' ' || substr(lpad(CAST(CRS_ARR_TIME AS VARCHAR), 4, '0'), 1, 2)
                 || ':' || substr(lpad(CAST(CRS_ARR_TIME AS VARCHAR), 4, '0'), 3, 2), '%Y-%m-%d %H:%M') AS CRS_ARR_TIMESTAMP,
    LEG_ID
  FROM {source}
  WHERE CANCELLED != 1 AND DIVERTED != 1
),
{name} AS (
  SELECT *, lag(ARR_DEL15) OVER (PARTITION BY TAIL_NUM
                                 ORDER BY CRS_DEP_TIMESTAMP ASC NULLS FIRST, LEG_ID ASC NULLS FIRST) AS PR_ARR_DEL15
  FROM {name}_typed
)"""


def _flight_select(alias: str = "") -> str:
    pre = f"{alias}." if alias else ""
    return ", ".join(f'{pre}"{c}"' for c in FLIGHT_NAMES)


FLIGHT_COLUMNS = _flight_select()

# Legs of the chosen airport, normalised, then hour keys (the feature pipeline's input).
PREPARED = f"""
base AS (
  SELECT * FROM legs
  WHERE (DEST = '{AIRPORT}' OR ORIGIN = '{AIRPORT}')
    AND FL_DATE > DATE '{LO}' AND FL_DATE < DATE '{END}'
),
{_norm('base', 'bnorm')},
fl AS (
  SELECT *, date_trunc('hour', CRS_DEP_TIMESTAMP) AS dep_time,
         date_trunc('hour', CRS_ARR_TIMESTAMP) AS arr_time,
         string_split(ORIGIN_CITY_NAME, ',')[1] AS ORIGIN_CITY,
         string_split(DEST_CITY_NAME, ',')[1] AS DEST_CITY
  FROM bnorm WHERE FL_DATE > DATE '{LO}' AND FL_DATE < DATE '{INF}'
)"""

OBS = f"""
obs AS (
  SELECT *, string_split(NAME, ',')[2] AS STATE FROM reports
  WHERE REPORT_TYPE = 'FM-15' AND NAME LIKE '% US'
    AND substring(NAME, -2, 2) = 'US' AND REPORT_TYPE LIKE '%FM-15%' AND NAME LIKE '% AIRPORT%'
    AND "DATE" > TIMESTAMP '{LO} 00:00:00' AND "DATE" < TIMESTAMP '{INF} 00:00:00'
)"""


def _decoded(source: str) -> str:
    def num(col: str, i: int) -> str:
        return f"TRY_CAST(string_split({col}, ',')[{i}] AS DOUBLE)"
    return f"""
    SELECT *, date_trunc('hour', "DATE") AS time,
      {num('TMP', 1)} * 9 / 50 + 32 AS temp_f,
      {num('WND', 4)} / 10 AS wnd_mps,
      {num('VIS', 1)} AS vis_m,
      {num('DEW', 1)} * 9 / 50 + 32 AS dew_pt_f,
      {num('SLP', 1)} / 10 AS slp_hpa,
      CASE WHEN {num('AA1', 1)} = 0 THEN NULL ELSE ({num('AA1', 2)} / 10) / {num('AA1', 1)} END AS precip_mm
    FROM {source}"""


def _mean(expr: str, alias: str) -> str:
    """A sum or mean of doubles as both engines compare it."""
    return f"round(round({expr}, 9), 6) AS {alias}"


HOURLY_AGGS = ", ".join([_mean("avg(temp_f)", "avg_temp_f"), _mean("sum(precip_mm)", "tot_precip_mm"),
                         _mean("avg(wnd_mps)", "avg_wnd_mps"), _mean("avg(vis_m)", "avg_vis_m"),
                         _mean("avg(slp_hpa)", "avg_slp_hpa"), _mean("avg(dew_pt_f)", "avg_dewpt_f")])

_hubs = ", ".join(f"('{code}', '{name}')" for code, name in sorted(HUBS.items()))

WEATHER_SIDES = f"""
dec AS ({_decoded("obs WHERE REPORT_TYPE = 'FM-15'")}),
local_w AS (SELECT time, {HOURLY_AGGS} FROM dec WHERE contains(CALL_SIGN, 'K{AIRPORT}') GROUP BY time),
codes AS (
  SELECT DEST AS code FROM fl WHERE contains(ORIGIN, '{AIRPORT}')
  UNION SELECT ORIGIN AS code FROM fl WHERE contains(DEST, '{AIRPORT}')
),
cities AS (
  SELECT code, min(city) AS city FROM (
    SELECT ORIGIN AS code, ORIGIN_CITY AS city FROM fl UNION ALL SELECT DEST, DEST_CITY FROM fl
  ) GROUP BY code
),
hubs(code, hub_name) AS (VALUES {_hubs}),
calls AS (SELECT DISTINCT trim(CALL_SIGN) AS cs FROM stations WHERE CALL_SIGN IS NOT NULL),
rules AS (
  SELECT c.code,
    CASE WHEN h.hub_name IS NOT NULL THEN 'hub' WHEN m.cs IS NULL THEN 'city' ELSE 'call' END AS rule,
    CASE WHEN h.hub_name IS NOT NULL OR m.cs IS NULL THEN 'NAME' ELSE 'CALL_SIGN' END AS field,
    CASE WHEN h.hub_name IS NOT NULL THEN h.hub_name
         WHEN m.cs IS NULL THEN replace(replace(upper(replace(ci.city, ' City', '')), '/', ' '), 'ST.', '')
         ELSE 'K' || c.code END AS needle
  FROM codes c
  LEFT JOIN hubs h ON c.code = h.code
  LEFT JOIN calls m ON m.cs = 'K' || c.code
  LEFT JOIN cities ci ON ci.code = c.code
),
stn AS (SELECT DISTINCT NAME, CALL_SIGN FROM obs),
matches AS (
  SELECT DISTINCT s.NAME, s.CALL_SIGN, r.code FROM stn s JOIN rules r
    ON (r.field = 'NAME' AND contains(s.NAME, r.needle))
    OR (r.field = 'CALL_SIGN' AND contains(s.CALL_SIGN, r.needle))
),
remote_w AS (
  SELECT m.code, d.time, {HOURLY_AGGS}
  FROM dec d JOIN matches m
    ON d.NAME IS NOT DISTINCT FROM m.NAME AND d.CALL_SIGN IS NOT DISTINCT FROM m.CALL_SIGN
  GROUP BY m.code, d.time
)"""


def _features_select(side: str) -> str:
    """The 51 final columns for departures ('dep') or arrivals ('arr')."""
    if side == "dep":
        local_key, remote_end, remote_key, where = "dep_time", "DEST", "arr_time", f"contains(f.ORIGIN, '{AIRPORT}')"
        local_p, remote_p = "dep_", "arr_"
    else:
        local_key, remote_end, remote_key, where = "arr_time", "ORIGIN", "dep_time", f"contains(f.DEST, '{AIRPORT}')"
        local_p, remote_p = "arr_", "dep_"
    flight = _flight_select("f")
    weather = {}
    for c in HOURLY:
        weather[local_p + c] = f"lw.{c}"
        weather[remote_p + c] = f"rw.{c}"
    order = [f"dep_{c}" for c in HOURLY] + [f"arr_{c}" for c in HOURLY]
    wcols = ", ".join(f"{weather[c]} AS {c}" for c in order)
    return f"""
  SELECT {flight}, f.dep_time, f.arr_time, f.ORIGIN_CITY, f.DEST_CITY, {wcols}
  FROM fl f
  LEFT JOIN local_w lw ON f.{local_key} = lw.time
  LEFT JOIN remote_w rw ON f.{remote_end} = rw.code AND f.{remote_key} = rw.time
  WHERE {where}"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


FEATURE_DOUBLES = ["DEP_DELAY_NEW", "ARR_DELAY_NEW", "DISTANCE",
                   *(f"dep_{c}" for c in HOURLY), *(f"arr_{c}" for c in HOURLY)]


def _pagerank_sql() -> str:
    rounds = []
    prev = "r0"
    for i in range(1, 6):
        rounds.append(f"""
r{i} AS (
  SELECT v.id, 0.15 + 0.85 * coalesce(c.s, 0.0) AS pr FROM v LEFT JOIN (
    SELECT w.dst, sum({prev}.pr * w.w) AS s FROM w JOIN {prev} ON w.src = {prev}.id GROUP BY w.dst
  ) c ON v.id = c.dst
)""")
        prev = f"r{i}"
    return _with(LEGS_RAW, """
v AS (SELECT DISTINCT ORIGIN AS id FROM legs),
e AS (SELECT ORIGIN AS src, DEST AS dst FROM legs
      WHERE ORIGIN IN (SELECT id FROM v) AND DEST IN (SELECT id FROM v)),
pairs AS (SELECT src, dst, count(*) AS n FROM e GROUP BY src, dst),
deg AS (SELECT src, sum(n) AS d FROM pairs GROUP BY src),
w AS (SELECT p.src, p.dst, CAST(p.n AS DOUBLE) / d.d AS w FROM pairs p JOIN deg d ON p.src = d.src),
r0 AS (SELECT id, 1.0::DOUBLE AS pr FROM v)""", *rounds) + """
SELECT id, round(round(pr * (SELECT count(*) FROM v) / (SELECT sum(pr) FROM r5), 9), 6) AS pagerank
FROM r5 ORDER BY pagerank DESC, id LIMIT 50"""


def _corr_sql(sides: str) -> str:
    parts = []
    for i, a in enumerate(FEATURE_DOUBLES):
        for b in FEATURE_DOUBLES[i:]:
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            x = f"CASE WHEN {both} THEN {a} END"
            y = f"CASE WHEN {both} THEN {b} END"
            r = (f"CASE WHEN stddev_pop({x}) * stddev_pop({y}) = 0 THEN NULL "
                 f"ELSE covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END")
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_mean(r, 'corr')} FROM feat")
            if a != b:
                parts.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {_mean(r, 'corr')} FROM feat")
    return f"{sides},\nfeat AS MATERIALIZED ({_features_select('dep')})\n" + "\nUNION ALL ".join(parts)


def _stats_base() -> str:
    return _with(LEGS_RAW, PREPARED, f"dep AS (SELECT * FROM fl WHERE contains(ORIGIN, '{AIRPORT}'))")


def oracle_sql() -> dict[str, str]:
    legs = _with(LEGS_RAW)
    reps = _with(REPORTS_RAW)
    out: dict[str, str] = {}

    out["scan_flights"] = legs + "\nSELECT * FROM legs"
    out["scan_weather_pred"] = reps + f"""
SELECT {REPORT_COLUMNS}
FROM reports WHERE REPORT_TYPE = 'FM-15' AND NAME LIKE '% US'"""
    out["view_sql"] = legs + """
SELECT OP_UNIQUE_CARRIER, count(*) AS n_legs,
       CAST(sum(CAST(DISTANCE AS DECIMAL(18, 4))) AS DOUBLE) AS total_distance
FROM legs WHERE CANCELLED = 0 GROUP BY OP_UNIQUE_CARRIER"""
    out["param_window"] = legs + f"""
SELECT LEG_ID, FL_DATE, DATE '{SPAN_HI}' + 1 AS inference_date FROM legs
WHERE FL_DATE > DATE '{SPAN_LO}' AND FL_DATE < DATE '{SPAN_HI}' + 1"""
    out["sink_overwrite_roundtrip"] = legs + f"""
SELECT ORIGIN, DEST, count(*) AS n_legs,
       CAST(sum(CAST(DISTANCE AS DECIMAL(18, 4))) AS DOUBLE) AS total_distance FROM legs
WHERE DEST = '{AIRPORT}' OR ORIGIN = '{AIRPORT}' GROUP BY ORIGIN, DEST"""
    out["conform_schema"] = """
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
       CAST(l_quantity AS FLOAT) AS l_quantity, CAST(l_returnflag AS VARCHAR) AS l_returnflag
FROM lineitem"""

    out["filter_either_end"] = legs + f"""
SELECT LEG_ID, ORIGIN, DEST FROM legs WHERE DEST = '{AIRPORT}' OR ORIGIN = '{AIRPORT}'"""
    out["filter_ts_open_span"] = reps + f"""
SELECT STATION, "DATE" FROM reports
WHERE "DATE" > TIMESTAMP '{SPAN_LO} 00:00:00' AND "DATE" < TIMESTAMP '{SPAN_HI} 00:00:00'"""
    out["filter_not_flagged"] = legs + """
SELECT LEG_ID, CANCELLED, DIVERTED FROM legs WHERE CANCELLED != 1 AND DIVERTED != 1"""
    out["filter_like_suffix"] = reps + """
SELECT STATION, "DATE", NAME FROM reports WHERE NAME LIKE '% US'"""
    out["filter_like_infix"] = reps + """
SELECT STATION, "DATE", REPORT_TYPE, NAME FROM reports
WHERE REPORT_TYPE LIKE '%FM-15%' AND NAME LIKE '% AIRPORT%'"""
    out["filter_derived"] = reps + """
SELECT STATION, "DATE", substring(NAME, -2, 2) AS COUNTRY FROM reports WHERE substring(NAME, -2, 2) = 'US'"""
    out["filter_contains"] = _with(LEGS_RAW, REPORTS_RAW) + f"""
SELECT 'leg' AS kind, LEG_ID AS id, NULL::TIMESTAMP AS ts FROM legs WHERE contains(ORIGIN, '{AIRPORT}')
UNION ALL
SELECT 'report' AS kind, STATION AS id, "DATE" AS ts FROM reports WHERE contains(CALL_SIGN, 'K{AIRPORT}')"""
    out["member_semi"] = legs + """
SELECT LEG_ID, DEST FROM legs WHERE DEST IN (
  SELECT n.n_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name = 'ASIA')"""

    out["normalise_flights"] = _with(LEGS_RAW, _norm("legs")) + f"\nSELECT {FLIGHT_COLUMNS} FROM norm"
    out["prior_arrival_late"] = _with(LEGS_RAW, _norm("legs")) + """
SELECT LEG_ID, TAIL_NUM, CRS_DEP_TIMESTAMP, ARR_DEL15, PR_ARR_DEL15 FROM norm"""
    out["cast_categoricals"] = legs + """
SELECT LEG_ID, CAST("YEAR" AS VARCHAR) AS "YEAR", CAST("QUARTER" AS VARCHAR) AS "QUARTER",
       CAST("MONTH" AS VARCHAR) AS "MONTH", CAST(DAY_OF_MONTH AS VARCHAR) AS DAY_OF_MONTH,
       CAST(DAY_OF_WEEK AS VARCHAR) AS DAY_OF_WEEK, CAST(DISTANCE_GROUP AS VARCHAR) AS DISTANCE_GROUP,
       CAST(DEP_DEL15 AS VARCHAR) AS DEP_DEL15, CAST(ARR_DEL15 AS VARCHAR) AS ARR_DEL15,
       CAST(OP_CARRIER_FL_NUM AS VARCHAR) AS OP_CARRIER_FL_NUM
FROM legs"""
    out["block_hour"] = legs + """
SELECT LEG_ID, DEP_TIME_BLK, ARR_TIME_BLK,
       TRY_CAST(substr(DEP_TIME_BLK, 1, 2) AS INTEGER) AS DEP_TIME_HOUR,
       TRY_CAST(substr(ARR_TIME_BLK, 1, 2) AS INTEGER) AS ARR_TIME_HOUR
FROM legs"""
    out["hhmm_round_hour"] = legs + """
SELECT LEG_ID, CRS_DEP_TIME, CRS_ARR_TIME,
       CAST(round(CRS_DEP_TIME / 100) AS INTEGER) AS CRS_DEP_TIME_HOUR,
       CAST(round(CRS_ARR_TIME / 100) AS INTEGER) AS CRS_ARR_TIME_HOUR
FROM legs"""
    out["minutes_to_hours"] = legs + """
SELECT LEG_ID, CAST(round(CRS_ELAPSED_TIME / 60) AS INTEGER) AS CRS_ELAPSED_HOURS FROM legs"""
    out["concat_keys"] = legs + """
SELECT LEG_ID, OP_CARRIER || '_' || CAST(OP_CARRIER_FL_NUM AS VARCHAR) AS FLIGHT_KEY,
       ORIGIN || '-' || DEST AS FL_PATH FROM legs"""
    ts = ("try_strptime(CAST(FL_DATE AS VARCHAR) || ' ' || substr(lpad(CAST({c} AS VARCHAR), 4, '0'), 1, 2) "
          "|| ':' || substr(lpad(CAST({c} AS VARCHAR), 4, '0'), 3, 2), '%Y-%m-%d %H:%M')")
    out["hhmm_timestamp"] = legs + f"""
SELECT LEG_ID, {ts.format(c='CRS_DEP_TIME')} AS CRS_DEP_TIMESTAMP,
       {ts.format(c='CRS_ARR_TIME')} AS CRS_ARR_TIMESTAMP FROM legs"""
    out["trunc_hour"] = reps + """
SELECT STATION, "DATE", date_trunc('hour', "DATE") AS time FROM reports"""
    out["split_city"] = legs + """
SELECT LEG_ID, string_split(ORIGIN_CITY_NAME, ',')[1] AS ORIGIN_CITY,
       string_split(DEST_CITY_NAME, ',')[1] AS DEST_CITY,
       string_split(DEST_CITY_NAME, ',')[2] AS DEST_STATE_TEXT FROM legs"""
    out["delay_label"] = legs + """
SELECT LEG_ID, DEP_DELAY AS delay,
       CASE WHEN DEP_DELAY IS NULL THEN NULL
            ELSE printf('%2.0fh%2.0fm', floor(DEP_DELAY / 60),
                        trunc(DEP_DELAY - 60 * floor(DEP_DELAY / 60))) END AS label
FROM legs"""

    out["select_weather"] = reps + f"""
SELECT {REPORT_COLUMNS}
FROM reports
WHERE substring(NAME, -2, 2) = 'US' AND REPORT_TYPE LIKE '%FM-15%' AND NAME LIKE '% AIRPORT%'"""
    out["decode_packed"] = reps + f"""
SELECT STATION, "DATE", temp_f, wnd_mps, vis_m,
       dew_pt_f, slp_hpa, precip_mm
FROM ({_decoded('reports')})"""
    out["hourly_obs"] = _with(REPORTS_RAW, OBS) + f"""
SELECT time, {HOURLY_AGGS} FROM ({_decoded("obs WHERE REPORT_TYPE = 'FM-15'")}) GROUP BY time"""
    prefixed = ", ".join(f"{c} AS dep_{c}" for c in HOURLY)
    out["prefix_columns"] = _with(REPORTS_RAW, OBS) + f"""
SELECT time AS dep_time, {prefixed} FROM (
  SELECT time, {HOURLY_AGGS} FROM ({_decoded("obs WHERE REPORT_TYPE = 'FM-15'")}) GROUP BY time)"""

    out["city_key"] = _with(LEGS_RAW, _norm("legs")) + """,
cities AS (
  SELECT code, min(city) AS city FROM (
    SELECT ORIGIN AS code, string_split(ORIGIN_CITY_NAME, ',')[1] AS city FROM norm
    UNION ALL SELECT DEST, string_split(DEST_CITY_NAME, ',')[1] FROM norm) GROUP BY code)
SELECT code, city, replace(replace(upper(replace(city, ' City', '')), '/', ' '), 'ST.', '') AS city_key
FROM cities"""
    out["call_sign"] = legs + """
SELECT DISTINCT ORIGIN AS code, 'K' || ORIGIN AS call_sign FROM legs"""
    out["dim_lookup"] = _with(LEGS_RAW, PREPARED) + """
SELECT code, min(city) AS city FROM (
  SELECT ORIGIN AS code, ORIGIN_CITY AS city FROM fl UNION ALL SELECT DEST, DEST_CITY FROM fl)
GROUP BY code"""
    out["missing_call_sign"] = _with(LEGS_RAW, REPORTS_RAW) + """
SELECT code, 'K' || code AS call_sign FROM (
  SELECT ORIGIN AS code FROM legs UNION SELECT DEST FROM legs)
WHERE 'K' || code NOT IN (SELECT trim(CALL_SIGN) FROM stations WHERE CALL_SIGN IS NOT NULL)"""
    sides = _with(LEGS_RAW, REPORTS_RAW, PREPARED, OBS, WEATHER_SIDES)
    out["station_match"] = sides + "\nSELECT NAME, CALL_SIGN, code FROM matches"
    lw = ", ".join(f"lw.{c} AS dep_{c}" for c in HOURLY)
    out["local_weather"] = sides + f"""
SELECT f.LEG_ID, f.dep_time, {lw}
FROM fl f LEFT JOIN local_w lw ON f.dep_time = lw.time WHERE contains(f.ORIGIN, '{AIRPORT}')"""
    rw = ", ".join(f"rw.{c} AS arr_{c}" for c in HOURLY)
    out["remote_weather"] = sides + f"""
SELECT f.LEG_ID, f.DEST, f.arr_time, {rw}
FROM fl f LEFT JOIN remote_w rw ON f.DEST = rw.code AND f.arr_time = rw.time
WHERE contains(f.ORIGIN, '{AIRPORT}')"""
    out["final_features"] = sides + _features_select("dep")
    out["arrival_features"] = sides + _features_select("arr")
    out["union_features"] = sides + f"""
SELECT *, 'dep' AS side FROM ({_features_select('dep')})
UNION ALL
SELECT *, 'arr' AS side FROM ({_features_select('arr')})"""

    out["route_vertices"] = legs + "\nSELECT DISTINCT ORIGIN AS id FROM legs"
    out["route_edges"] = legs + """
SELECT ORIGIN_AIRPORT_SEQ_ID AS tripId, DEP_DELAY AS delay, ORIGIN AS src, DEST AS dst,
       string_split(DEST_CITY_NAME, ',')[1] AS city_dst, DEST_STATE_ABR AS state_dst FROM legs"""
    out["edges_out_delayed"] = legs + f"""
SELECT OP_CARRIER AS operator, DEP_DELAY AS delay, ORIGIN AS src, DEST AS dst,
       string_split(DEST_CITY_NAME, ',')[1] AS city_dst, DEST_STATE_ABR AS state_dst
FROM legs WHERE ORIGIN = '{AIRPORT}' AND DEP_DELAY > 0"""
    out["edges_in_delayed"] = legs + f"""
SELECT OP_UNIQUE_CARRIER AS operator, ARR_DELAY_NEW AS delay, ORIGIN AS src, DEST AS dst,
       string_split(ORIGIN_CITY_NAME, ',')[1] AS city_org, ORIGIN_STATE_ABR AS state_org
FROM legs WHERE DEST = '{AIRPORT}' AND ARR_DELAY_NEW > 0"""
    out["delays_by_carrier"] = legs + f"""
SELECT OP_CARRIER AS operator, count(DEP_DELAY) AS n_delayed FROM legs
WHERE ORIGIN = '{AIRPORT}' AND DEP_DELAY > 0 GROUP BY OP_CARRIER"""
    prepared = _with(LEGS_RAW, PREPARED)
    out["delays_into_by_carrier"] = prepared + f"""
SELECT OP_UNIQUE_CARRIER AS operator, count(ARR_DELAY_NEW) AS n_delayed FROM fl
WHERE DEST = '{AIRPORT}' AND ARR_DELAY_NEW > 0 GROUP BY OP_UNIQUE_CARRIER"""
    out["delays_by_weekday_dst"] = prepared + f"""
SELECT DAY_OF_WEEK AS day_of_week, DEST AS dst, count(DEP_DELAY_NEW) AS n_delayed FROM fl
WHERE ORIGIN = '{AIRPORT}' AND DEP_DELAY_NEW > 0 GROUP BY DAY_OF_WEEK, DEST"""
    out["delays_by_weekday_src"] = prepared + f"""
SELECT DAY_OF_WEEK AS day_of_week, ORIGIN AS src, count(ARR_DELAY_NEW) AS n_delayed FROM fl
WHERE DEST = '{AIRPORT}' AND ARR_DELAY_NEW > 0 GROUP BY DAY_OF_WEEK, ORIGIN"""
    out["mean_delay_by_dst"] = legs + f"""
SELECT ORIGIN AS src, DEST_STATE_ABR AS state_dst, DEST AS dst, {_mean('avg(DEP_DELAY)', 'avg_delay')}
FROM legs WHERE ORIGIN = '{AIRPORT}' AND DEP_DELAY > 0 GROUP BY ORIGIN, DEST_STATE_ABR, DEST"""
    out["mean_delay_by_path"] = prepared + f"""
SELECT FL_PATH AS path, {_mean('avg(DEP_DELAY_NEW)', 'avg_delay')}
FROM fl WHERE ORIGIN = '{AIRPORT}' AND DEP_DELAY_NEW > 0 GROUP BY FL_PATH"""
    out["two_hop_motif"] = legs + f""",
v AS (SELECT DISTINCT ORIGIN AS id FROM legs),
e AS (SELECT ORIGIN_AIRPORT_SEQ_ID AS trip, DEP_DELAY AS delay, ORIGIN AS src, DEST AS dst FROM legs)
SELECT ab.src AS a, count(*) AS n_paths
FROM e ab JOIN e bc ON ab.dst = bc.src
WHERE ab.dst = '{AIRPORT}' AND bc.dst = '{OTHER_AIRPORT}'
  AND ab.src IN (SELECT id FROM v) AND ab.dst IN (SELECT id FROM v) AND bc.dst IN (SELECT id FROM v)
  AND (ab.delay > 500 OR bc.delay > 500)
  AND bc.trip > ab.trip AND bc.trip > ab.trip + 10000
GROUP BY ab.src"""
    out["pagerank_top50"] = _pagerank_sql()

    out["collect_distinct"] = legs + """
SELECT DEST AS value, row_number() OVER (ORDER BY DEST) AS place FROM (SELECT DISTINCT DEST FROM legs WHERE DEST IS NOT NULL)"""
    out["distinct_pairs"] = legs + """
SELECT DISTINCT DEST, string_split(DEST_CITY_NAME, ',')[1] AS DEST_CITY FROM legs"""
    base = _stats_base()
    out["carrier_stats"] = base + f"""
SELECT OP_UNIQUE_CARRIER AS carrier, min(DEP_DELAY_NEW) AS min_delay,
       max(DEP_DELAY_NEW) AS max_delay, count(DEP_DELAY_NEW) AS n_delay,
       {_mean('avg(DEP_DELAY_NEW)', 'mean_delay')}
FROM dep WHERE OP_UNIQUE_CARRIER IS NOT NULL GROUP BY OP_UNIQUE_CARRIER"""
    out["carrier_share"] = base + """,
c AS (SELECT OP_UNIQUE_CARRIER AS carrier, count(DEP_DELAY_NEW) AS n_delay FROM dep
      WHERE OP_UNIQUE_CARRIER IS NOT NULL GROUP BY OP_UNIQUE_CARRIER)
SELECT carrier, n_delay, n_delay * 100.0::DOUBLE / sum(n_delay) OVER () AS share_pct,
       round_even(n_delay * 100.0::DOUBLE / sum(n_delay) OVER (), 0) AS share_label FROM c"""
    out["carrier_mean_clipped"] = base + f""",
c AS (SELECT OP_UNIQUE_CARRIER AS carrier, avg(DEP_DELAY_NEW) AS m FROM dep
      WHERE OP_UNIQUE_CARRIER IS NOT NULL GROUP BY OP_UNIQUE_CARRIER)
SELECT carrier, {_mean('greatest(m, 0.0::DOUBLE)', 'mean_clipped')}, round_even(greatest(m, 0.0::DOUBLE), 0) AS mean_label FROM c"""
    out["delay_distribution"] = base + """
SELECT OP_UNIQUE_CARRIER AS carrier, floor(DEP_DELAY_NEW / 15.0) * 15.0 AS bin_lo, count(*) AS n
FROM dep WHERE DEP_DELAY_NEW IS NOT NULL GROUP BY OP_UNIQUE_CARRIER, floor(DEP_DELAY_NEW / 15.0) * 15.0"""
    out["delay_quantiles"] = base + """
SELECT OP_UNIQUE_CARRIER AS carrier, round(round(quantile_cont(DEP_DELAY_NEW, 0.25), 9), 6) AS q25,
       round(round(quantile_cont(DEP_DELAY_NEW, 0.5), 9), 6) AS q50,
       round(round(quantile_cont(DEP_DELAY_NEW, 0.75), 9), 6) AS q75
FROM dep WHERE DEP_DELAY_NEW IS NOT NULL GROUP BY OP_UNIQUE_CARRIER"""
    out["delay_sketch_bound"] = base + """
SELECT OP_UNIQUE_CARRIER AS carrier, CAST(p AS DOUBLE) AS prob, count(*) AS n, TRUE AS within
FROM dep, (VALUES (0.25), (0.5), (0.75)) AS probs(p) WHERE DEP_DELAY_NEW IS NOT NULL GROUP BY ALL"""
    out["select_by_type"] = sides + f"SELECT {', '.join(FEATURE_DOUBLES)} FROM ({_features_select('dep')})"
    out["corr_matrix"] = _corr_sql(sides)
    return out
