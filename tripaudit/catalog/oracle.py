"""DuckDB statements for the registered queries, over the same tables.

Written independently of the operators: no statement uses slices, salts or
reductions ahead of joins.
"""

from __future__ import annotations

E0 = 1489939200

FX_ORDER = f"""
fx_order AS (
  SELECT *,
    start_time - l_partkey % 1500 AS arrival_time,
    start_time + (minutes - 1) * 60 + l_partkey % 60 AS end_time,
    start_longitude + (l_linenumber - 1) * 1e-2 AS expect_start_longitude,
    start_latitude + (minutes % 10) * 5e-3 AS expect_start_latitude,
    start_longitude + (l_linenumber - 1) * 3e-2 AS expect_end_longitude,
    CAST(20170320 + (start_time - {E0}) // 86400 AS INTEGER) AS dt
  FROM (
    SELECT l_orderkey AS service_order_id, n_name AS city,
      CASE WHEN l_linestatus = 'F' THEN 7 ELSE 8 END AS status,
      'p' || l_partkey || CASE WHEN l_linenumber = 7 THEN '测试' ELSE '' END AS passenger_name,
      l_suppkey AS driver_id,
      {E0} + date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 10 * 86400
        + (l_orderkey * 7919 + l_partkey * 104729) % 86400 AS start_time,
      116e0 + (l_partkey % 100) / 1000 AS start_longitude,
      399e-1 + (l_suppkey % 100) / 1000 AS start_latitude,
      CAST(CASE WHEN l_returnflag = 'N' THEN 1 + l_orderkey % 50 ELSE CAST(l_quantity AS INTEGER) END
        AS INTEGER) AS actual_time_length,
      greatest(CAST(round(l_tax * 100) AS INTEGER) - 2, 0) * 750 AS dependable_distance,
      greatest(CAST(round(l_discount * 100) AS INTEGER) - 2, 0) * 500 AS system_distance,
      date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) * 86400 + l_linenumber AS update_time,
      CAST(l_quantity AS INTEGER) AS minutes, l_partkey, l_linenumber, l_extendedprice
    FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
  )
)"""

FX_EXT = """
fx_ext AS (
  SELECT o_orderkey AS service_order_id,
    CASE substr(o_orderpriority, 1, 1)
      WHEN '1' THEN ''
      WHEN '2' THEN (o_custkey % 5) || '_1' || suffix
      WHEN '3' THEN (o_custkey % 5) || '_2' || suffix
      WHEN '4' THEN (o_custkey % 5) || '_9' || suffix
      ELSE 'v' || (o_custkey % 5) || suffix END AS driver_version,
    CAST(1 + o_orderkey % 50 AS INTEGER) AS runtime,
    CASE WHEN o_custkey % 17 = 0 THEN 'not json'
      ELSE '{"distance":"' || CAST(floor(o_totalprice / 50) AS BIGINT) || '"}' END AS estimate_snap,
    date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400 + v AS update_time,
    CAST(CASE WHEN v = 0 THEN 20170320 + (o_orderkey + o_custkey) % 10 WHEN o_custkey % 2 = 0 THEN 20170329
      ELSE 20170310 END AS INTEGER) AS dt
  FROM (
    SELECT *, CASE WHEN v = 1 AND o_custkey % 3 = 0 THEN '_b' ELSE '' END AS suffix
    FROM orders CROSS JOIN (VALUES (0), (1)) AS versions(v)
  )
)"""

PREDICTED = """CAST(trunc(TRY_CAST(CASE WHEN json_valid(estimate_snap)
    THEN json_extract_string(estimate_snap, '$.distance') END AS DOUBLE)) AS INTEGER)"""

LATEST_EXT = f"""
newest_ext AS (
  SELECT service_order_id, driver_version, runtime, {PREDICTED} AS predict_distance
  FROM fx_ext
  QUALIFY row_number() OVER (PARTITION BY service_order_id ORDER BY update_time DESC) = 1
)"""

BASIC = "driver_version <> '' AND status = 7 AND passenger_name NOT LIKE '%测试%'"
NEWEST = "ORDER BY update_time DESC, l_linenumber DESC, l_extendedprice DESC"

FX_VALID = f"""
fx_valid AS (
  SELECT * FROM fx_order JOIN newest_ext USING (service_order_id) WHERE {BASIC}
)"""

FX_ZERO = f"""
fx_zero AS (
  SELECT * FROM fx_order
  JOIN (SELECT DISTINCT service_order_id, driver_version FROM fx_ext) USING (service_order_id)
  WHERE {BASIC} AND system_distance = 0 AND dependable_distance = 0
)"""

FX_RISK = """
fx_risk AS (
  SELECT o_orderkey AS service_order_id, CASE WHEN o_custkey % 10 = 0 THEN 'T' ELSE 'F' END AS is_rc,
    CAST(20170315 + o_orderkey % 15 AS INTEGER) AS dt
  FROM orders
)"""

FX_CITY = """
fx_city AS (
  SELECT CASE WHEN n_nationkey < 20 THEN n_name ELSE 'old ' || n_name END AS code, 'CITY_' || n_nationkey AS label
  FROM nation
)"""

FX_DEVICE = """
fx_device AS (
  SELECT event_id AS device_id, user_id, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS status,
    CASE WHEN event_id % 4 = 0 THEN 'PA' ELSE 'DR' END AS user_type, epoch_us(ts) AS update_time,
    json_extract_string(props, '$.k') AS app_version, event_type AS os_type, 'v' || event_id % 7 AS os_version,
    'os ' || event_type AS os_name, 'type ' || event_id % 3 AS device_type
  FROM events
),
newest_device AS (
  SELECT * FROM fx_device WHERE status = 1 AND user_id > 0
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY update_time DESC, device_id DESC) = 1
)"""

FX_LOG = r"""
fx_log AS (
  SELECT CAST(20170320 + o_orderkey % 10 AS INTEGER) AS log_day, concat_ws(chr(9), 'a', 'b',
    CAST(o_orderkey AS VARCHAR), 'c',
    CASE WHEN o_custkey % 7 = 0 THEN 'NULL' ELSE CAST(km AS VARCHAR) END, 'd', CAST(km + 1 AS VARCHAR), 'e',
    CAST(km + 2 AS VARCHAR), CAST(km + 3 AS VARCHAR), 'f', 'g', 'h',
    CASE o_custkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' ELSE 'x' END) AS value
  FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) // 1000 AS km FROM orders)
),
parsed_log AS (
  SELECT log_day, p[3] AS service_order_id,
    coalesce(TRY_CAST(p[5] AS DOUBLE), 0) AS r_yy_dis, coalesce(TRY_CAST(p[7] AS DOUBLE), 0) AS r_sys_dis,
    coalesce(TRY_CAST(p[9] AS DOUBLE), 0) AS driver_dis, coalesce(TRY_CAST(p[10] AS DOUBLE), 0) AS response_dis,
    coalesce(TRY_CAST(p[14] AS BIGINT), 0) AS is_enable
  FROM (SELECT log_day, string_split(value, chr(9)) AS p FROM fx_log)
)"""

DIV = "CASE user_id % 3 WHEN 0 THEN 720 WHEN 1 THEN 4320 ELSE 1440 END"

FX_TRIP_ALL = f"""
fx_trip AS (
  SELECT user_id AS service_order_id, start_time - (user_id % 20) * 60 AS arrival_time, start_time, end_time,
    CASE WHEN user_id % 11 = 0 THEN 0 ELSE 1000 + user_id * 100 END AS predict_distance,
    (user_id % 13) / 10 * (1 + user_id * 1e-1) AS system_distance
  FROM (
    SELECT user_id, {E0} + CAST(floor(span * 1e-1) AS BIGINT) AS start_time,
      {E0} + CAST(floor(span * 9e-1) AS BIGINT) AS end_time
    FROM (SELECT DISTINCT user_id, 2592000 // ({DIV}) AS span FROM events)
  )
),
all_point AS (
    SELECT event_id, user_id, user_id AS service_order_id,
      {E0} + CAST(floor((epoch_us(ts) / 1e6 - 1704067200) / ({DIV})) AS BIGINT) AS t,
      399e-1 + value / 1000 AS latitude,
      116e0 + CAST(json_extract_string(props, '$.k') AS INTEGER) / 1000 AS longitude
    FROM events
),
fx_point AS (SELECT * EXCLUDE (user_id) FROM all_point p WHERE true),
near AS (
  SELECT x.*, p.* EXCLUDE (service_order_id) FROM fx_trip x JOIN fx_point p USING (service_order_id)
  WHERE p.t BETWEEN x.start_time - 300 AND x.end_time + 300
),
in_trip AS (SELECT * FROM near WHERE t BETWEEN start_time AND end_time),
gaps AS (
  SELECT service_order_id, t,
    lead(t) OVER (PARTITION BY service_order_id ORDER BY t, event_id) - t AS gap FROM in_trip
)"""

# The same with the middle of every fifth track lost.
FX_TRIP_LOST = FX_TRIP_ALL.replace(
    "WHERE true",
    """WHERE NOT EXISTS (
    SELECT 1 FROM fx_trip x WHERE x.service_order_id = p.service_order_id AND p.user_id % 5 = 0
      AND p.t > x.start_time + 2e-1 * (x.end_time - x.start_time)
      AND p.t < x.start_time + 8e-1 * (x.end_time - x.start_time)
  )""",
)

# The same with the end of every third trip in milliseconds; what is lost depends on the true ends.
BROKEN_TRIP_LOST = (
    FX_TRIP_LOST.replace("fx_trip", "true_trip").replace("true_trip x JOIN fx_point p", "fx_trip x JOIN fx_point p")
).replace(
    "all_point AS (",
    """fx_trip AS (
  SELECT * REPLACE (CASE WHEN service_order_id % 3 = 0 THEN end_time * 1000 ELSE end_time END AS end_time) FROM true_trip
),
all_point AS (""",
)

DIST_COND = """round(dependable_distance / 1000, 1) > round(system_distance / 1000, 1)
    AND runtime = actual_time_length"""
OP_COND = """round(dependable_distance / 1000, 1) <> round(system_distance / 1000, 1)
    AND runtime <> actual_time_length"""


def _suspects(name: str, cond: str) -> str:
    return f"""
{name} AS (
  SELECT *, round(system_distance / 1000, 1) AS sys_km, round(dependable_distance / 1000, 1) AS dep_km
  FROM fx_valid WHERE {cond}
  QUALIFY row_number() OVER (PARTITION BY service_order_id {NEWEST}) = 1
)"""


DIST = _suspects("dist", DIST_COND)
OP = _suspects("op", OP_COND)

DRIVER_HIST = """
hist AS (
  SELECT dt, driver_id, count(*) FILTER (system_distance = 0 AND dependable_distance = 0) AS zero_cnt,
    count(*) AS total_cnt
  FROM fx_valid WHERE dt < 20170329
  GROUP BY dt, driver_id
  HAVING count(*) FILTER (system_distance = 0 AND dependable_distance = 0) > 0
),
today AS (
  SELECT driver_id, count(*) FILTER (system_distance = 0 AND dependable_distance = 0) AS zero_cnt,
    count(*) AS total_cnt
  FROM fx_valid WHERE dt = 20170329 GROUP BY driver_id
  HAVING count(*) FILTER (system_distance = 0 AND dependable_distance = 0) > 0
)"""

SUMMARY_BASE = f"""
base AS (
  SELECT dt, service_order_id, system_distance, dependable_distance, start_time
  FROM (
    SELECT fx_order.* FROM fx_order
    JOIN (SELECT DISTINCT service_order_id, driver_version FROM fx_ext WHERE dt BETWEEN 20170320 AND 20170329)
      USING (service_order_id)
    WHERE {BASIC}
    QUALIFY row_number() OVER (PARTITION BY service_order_id {NEWEST}) = 1
  )
)"""

DAY_BASE = f"""
day_base AS (
  SELECT service_order_id, city, status, system_distance, dependable_distance, driver_version, driver_id,
    start_longitude, start_latitude, expect_start_longitude, expect_start_latitude, expect_end_longitude,
    start_time, end_time,
    service_order_id IN (SELECT service_order_id FROM fx_risk WHERE is_rc = 'T' AND dt > 20170319) AS is_rc
  FROM fx_order
  JOIN (SELECT DISTINCT service_order_id, driver_version FROM fx_ext WHERE dt = 20170329) USING (service_order_id)
  WHERE {BASIC} AND dt = 20170329
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


ORDERS = _with(FX_ORDER)
EXTS = _with(FX_EXT)
VALID = _with(FX_ORDER, FX_EXT, LATEST_EXT, FX_VALID)
SUSPECTS = _with(FX_ORDER, FX_EXT, LATEST_EXT, FX_VALID, DIST, OP)
IN_WINDOW = LATEST_EXT.replace("FROM fx_ext", "FROM fx_ext WHERE dt BETWEEN 20170320 AND 20170329")
WINDOW_SUSPECTS = _with(FX_ORDER, FX_EXT, IN_WINDOW, FX_VALID, DIST, OP)
RISK = _with(FX_ORDER, FX_RISK)
ZERO = _with(FX_ORDER, FX_EXT, FX_ZERO)
TRACK = _with(FX_TRIP_ALL)
LOST = _with(FX_TRIP_LOST)
DRIVERS = _with(FX_ORDER, FX_EXT, LATEST_EXT, FX_VALID, DRIVER_HIST)

_PER_MILLE = "round_even({part} / {total}, 4) * 1000"


def _summary(flag: str, sys_part: str, rest: str, no_rc: str) -> str:
    rates = {"sys_zero_rate": "sys_zero", "no_rc_rate": "no_rc_zero", "adjust_zero_rate": "adjust_zero",
             "ext_zero_rate": "ext_zero"}
    rated = ", ".join(f"{_PER_MILLE.format(part=p, total='total')} AS {r}" for r, p in rates.items())
    return f"""
    SELECT *, {rated} FROM (
      SELECT *, {rest} - adjust_zero AS ext_zero FROM (
        SELECT dt, count(*) AS total, count(*) FILTER (system_distance = 0) AS sys_zero,
          {no_rc} AS no_rc_zero,
          count(*) FILTER (system_distance = 0 AND dependable_distance = 0 AND {flag}) AS adjust_zero
        FROM {sys_part} GROUP BY dt))"""


def _hist(value: str, source: str, edges: list[str], labels: list[str], name: str) -> str:
    rows = ", ".join(
        f"({i}, '{label}', {edges[i]}, {edges[i + 1]})" for i, label in enumerate(labels)
    )
    return f"""
    SELECT CAST(b.bin AS INTEGER) AS bin, b.label AS {name}, count(v.x) AS cnt
    FROM (VALUES {rows}) AS b(bin, label, low, high)
    LEFT JOIN (SELECT {value} AS x FROM {source}) v ON v.x > b.low AND v.x <= b.high
    GROUP BY b.bin, b.label"""


def _pickup(lon2: str) -> str:
    lat1, lat2 = "radians(start_latitude)", "radians(expect_start_latitude)"
    dlon = f"(radians({lon2}) - radians(start_longitude)) / 2"
    h = f"pow(sin(({lat2} - {lat1}) / 2), 2) + cos({lat1}) * cos({lat2}) * pow(sin({dlon}), 2)"
    return f"round_even(2 * asin(sqrt({h})) * 6371 * 1000 / 1000, 1)"


KM_EDGES = ["0", "2e-1", "5e-1", "8e-1", "1", "15e-1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "10000000"]
KM_LABELS = ["0.2", "0.5", "0.8", "1", "1.5", "2", "3", "4", "5", "6", "7", "8", "9", "10", "10+"]
MIN_EDGES = [str(i) for i in range(21)] + ["100000"]
MIN_LABELS = [str(i) for i in range(1, 21)] + ["20+"]

DIST_DETAIL = """
  SELECT CAST(service_order_id AS VARCHAR) AS service_order_id, CAST(driver_id AS VARCHAR) AS driver_id,
    CAST(arrival_time AS INTEGER) AS arrival_time, CAST(start_time AS INTEGER) AS start_time,
    CAST(end_time AS INTEGER) AS end_time, CAST(update_time AS INTEGER) AS update_time,
    driver_version, predict_distance, sys_km AS system_distance, dep_km AS dependable_distance,
    dep_km - sys_km AS deviation_distance,
    round(100 * (dependable_distance - system_distance) / dependable_distance, 0) AS pct_for_sort,
    concat(round(100 * (dependable_distance - system_distance) / dependable_distance, 0), '%')
      AS percent_deviation_distance
  FROM dist"""

OP_DETAIL = """
  SELECT CAST(service_order_id AS VARCHAR) AS service_order_id, CAST(driver_id AS VARCHAR) AS driver_id,
    CAST(arrival_time AS INTEGER) AS arrival_time, CAST(start_time AS INTEGER) AS start_time,
    CAST(end_time AS INTEGER) AS end_time, CAST(update_time AS INTEGER) AS update_time,
    driver_version, predict_distance, runtime AS system_time, actual_time_length AS dependable_time,
    round(100 * (actual_time_length - runtime) / actual_time_length, 0) AS pct_for_sort,
    concat(round(100 * (actual_time_length - runtime) / actual_time_length, 0), '%') AS percent_time,
    sys_km AS system_distance, dep_km AS dependable_distance, dep_km - sys_km AS deviation_distance,
    CASE WHEN dep_km - sys_km > 0 THEN 1 ELSE 0 END AS "isDeviationPositive"
  FROM op"""


def _clock(epoch: str) -> str:
    return f"strftime(TIMESTAMP '1970-01-01' + to_seconds({epoch} + 28800), '%Y-%m-%d %H:%M:%S')"


def _yyyymmdd(epoch: str) -> str:
    return f"CAST(strftime(TIMESTAMP '1970-01-01' + to_seconds({epoch} + 28800), '%Y%m%d') AS INTEGER)"


# Mean interval of the fixes in a phase: divisor is the count, cut to seconds.
def _mean(cond: str) -> str:
    return f"""coalesce(CAST(floor((max(t) FILTER ({cond}) - min(t) FILTER ({cond}))
      / nullif(count(*) FILTER ({cond}), 0)) AS BIGINT), 0)"""


TRACK_STATS = f"""
phase AS (
  SELECT service_order_id, {_mean("t <= start_time")} AS avg_before,
    {_mean("t BETWEEN start_time AND end_time")} AS avg_in, {_mean("t >= end_time")} AS avg_after,
    count(*) FILTER (t BETWEEN start_time AND end_time) AS n_in
  FROM near GROUP BY service_order_id
),
gap_stats AS (
  SELECT service_order_id, min(gap) AS min_gap, max(gap) AS max_gap,
    count(DISTINCT gap) FILTER (gap > 300) AS n_long_gaps
  FROM gaps GROUP BY service_order_id
),
positions AS (
  SELECT service_order_id, count(DISTINCT (latitude, longitude)) AS n_positions
  FROM in_trip GROUP BY service_order_id
),
stats AS (
  SELECT service_order_id, avg_before, avg_in, avg_after,
    CASE WHEN n_in > 0 THEN min_gap ELSE -1 END AS min_gap, CASE WHEN n_in > 0 THEN max_gap ELSE -1 END AS max_gap,
    coalesce(n_long_gaps, 0) AS n_long_gaps, coalesce(n_positions, 0) AS n_positions
  FROM phase LEFT JOIN gap_stats USING (service_order_id) LEFT JOIN positions USING (service_order_id)
)"""

def _order_track(suspects: str) -> str:
    return f"""
near AS (
  SELECT d.service_order_id, d.start_time, d.end_time, p.t, p.latitude, p.longitude FROM {suspects} d JOIN (
    SELECT service_order_id, start_time + i * ((end_time - start_time) // 5) AS t,
      start_latitude + i * 1e-3 AS latitude, start_longitude AS longitude
    FROM fx_order CROSS JOIN range(6) AS steps(i)
  ) p USING (service_order_id)
  WHERE p.t BETWEEN d.start_time - 300 AND d.end_time + 300
),
in_trip AS (SELECT * FROM near WHERE t BETWEEN start_time AND end_time),
gaps AS (
  SELECT service_order_id, t, lead(t) OVER (PARTITION BY service_order_id ORDER BY t) - t AS gap FROM in_trip
)"""

# Rule chain over a trip row and its track statistics ``s``.
def _susp_type(km: str) -> str:
    ratio = f"({km} / nullif(predict_distance / 1000, 0))"
    return f"""CASE
      WHEN s.service_order_id IS NULL THEN '无轨迹数据'
      WHEN avg_before < 15 AND avg_after < 15 AND max_gap / nullif(end_time - start_time, 0) > 5e-1
        AND end_time - start_time > 300 AND n_long_gaps < 2 THEN '开始和结束正常，中途丢点'
      WHEN start_time - arrival_time > 600 AND {ratio} < 8e-1 AND avg_in <= 10 THEN '轨迹正常，司机忘记点击出发'
      WHEN {ratio} BETWEEN 2e-1 AND 8e-1 AND n_positions > 2 THEN '行驶途中丢点'
      WHEN {ratio} BETWEEN 8e-1 AND 11e-1 AND avg_in <= 10 THEN '轨迹、里程无误，但司机异议'
      ELSE 'unknow' END"""


def _sheet(suspects: str, detail: str, where: str) -> str:
    """A sheet of the suspicious report, all columns."""
    stamps = ", ".join(f"{_clock('d.' + c)} AS {c}" for c in ("arrival_time", "start_time", "end_time", "update_time"))
    sign = ', "isDeviationPositive"' if suspects == "op" else ""
    return f"""{WINDOW_SUSPECTS}, {FX_DEVICE}, {FX_LOG}, {_order_track(suspects)}, {TRACK_STATS},
      detail AS ({detail}),
      typed AS (SELECT service_order_id, {_susp_type('sys_km')} AS susp_type
        FROM {suspects} LEFT JOIN stats s USING (service_order_id))
      SELECT x.* EXCLUDE (arrival_time, start_time, end_time, update_time, pct_for_sort{sign}), {stamps},
        substr({_clock('d.start_time')}, 1, 10) AS date, n.os_type, n.os_version, n.os_name, n.app_version,
        coalesce({_clock('n.update_time // 1000000')}, '') AS device_update, susp_type,
        r_yy_dis, r_sys_dis, driver_dis, response_dis, is_enable,
        CASE WHEN d.service_order_id IN (SELECT service_order_id FROM dist WHERE dt < 20170327) THEN 0 ELSE 1 END AS is_new
      FROM {suspects} d JOIN typed USING (service_order_id)
      JOIN detail x ON x.service_order_id = CAST(d.service_order_id AS VARCHAR)
      LEFT JOIN newest_device n ON n.user_type = 'DR' AND n.user_id = d.driver_id
      LEFT JOIN parsed_log g ON g.service_order_id = CAST(d.service_order_id AS VARCHAR)
        AND g.log_day = {_yyyymmdd('d.end_time')}
      WHERE {where}"""


EXTRACT = """service_order_id, city, status, passenger_name, driver_id, start_time, start_longitude,
    system_distance, update_time, l_linenumber, l_extendedprice, dt"""
ROW = "service_order_id, l_linenumber, l_extendedprice"


def oracle_sql() -> dict[str, str]:
    risk_ids = "(SELECT service_order_id FROM fx_risk WHERE is_rc = 'T')"
    recent_ids = "(SELECT service_order_id FROM fx_risk WHERE is_rc = 'T' AND dt > 20170319)"
    devices = f"{VALID}, {FX_DEVICE}"
    seen = "(SELECT service_order_id FROM dist WHERE dt < 20170327 AND dt >= 20170317)"
    daily = "SELECT dt, count(*) AS cnt FROM fx_order"
    return {
        "valid_trips": f"""{VALID} SELECT service_order_id, l_linenumber, dt, driver_version, status,
            passenger_name, driver_id FROM fx_valid""",
        "time_window": f"""{ORDERS} SELECT service_order_id, l_linenumber, start_time, dt FROM fx_order
            WHERE start_time BETWEEN epoch(TIMESTAMP '2017-03-23 00:00:00') - 28800
              AND epoch(TIMESTAMP '2017-03-25 23:59:59') - 28800""",
        "dt_prefix": f"""{ORDERS} SELECT service_order_id, l_linenumber, dt_hour FROM (
            SELECT *, CAST(dt * 100 + (start_time + 28800) % 86400 // 3600 AS INTEGER) AS dt_hour FROM fx_order)
            WHERE CAST(dt_hour AS VARCHAR) LIKE '20170322%'""",
        "pure_zero": f"""{VALID}, {FX_RISK} SELECT service_order_id, l_linenumber, system_distance,
            dependable_distance, false AS is_rc FROM fx_valid
            WHERE system_distance = 0 AND dependable_distance = 0 AND service_order_id NOT IN {recent_ids}""",
        "risk_list": f"{_with(FX_RISK)} SELECT * FROM fx_risk WHERE is_rc = 'T' AND dt > 20170319",
        "deviation_cols": f"""{VALID} SELECT service_order_id, l_linenumber, sys_km AS system_distance,
            dep_km AS dependable_distance, dep_km - sys_km AS deviation_distance, distance_pct,
            CASE WHEN distance_pct IS NOT NULL THEN concat(distance_pct, '%') END AS percent_deviation_distance,
            time_pct, concat(time_pct, '%') AS percent_time,
            CASE WHEN dep_km - sys_km > 0 THEN 1 ELSE 0 END AS "isDeviationPositive"
            FROM (SELECT *, floor((system_distance + 50) / 100) / 10 AS sys_km,
              floor((dependable_distance + 50) / 100) / 10 AS dep_km,
              round(100 * (dependable_distance - system_distance) / nullif(dependable_distance, 0), 0)
                AS distance_pct,
              round(100 * (actual_time_length - runtime) / nullif(actual_time_length, 0), 0) AS time_pct
              FROM fx_valid)""",
        "dist_suspects": f"{SUSPECTS} {DIST_DETAIL} ORDER BY pct_for_sort DESC, deviation_distance DESC",
        "op_suspects": f"{SUSPECTS} {OP_DETAIL} ORDER BY pct_for_sort DESC, deviation_distance DESC",
        "op_split": f"""{SUSPECTS} SELECT service_order_id, pct_for_sort, deviation_distance,
            CASE WHEN "isDeviationPositive" = 1 THEN 'no_start' ELSE 'no_end' END AS side FROM ({OP_DETAIL})
            ORDER BY pct_for_sort, deviation_distance""",
        "format_detail": f"""{SUSPECTS}, {FX_DEVICE} SELECT d.service_order_id, d.driver_id,
            {_clock('arrival_time')} AS arrival_time, {_clock('start_time')} AS start_time,
            {_clock('end_time')} AS end_time, {_clock('d.update_time')} AS update_time, driver_version,
            predict_distance, system_distance, dependable_distance, deviation_distance,
            percent_deviation_distance, n.os_type, n.os_version, n.os_name, n.app_version,
            coalesce({_clock('n.update_time // 1000000')}, '') AS device_update,
            substr({_clock('start_time')}, 1, 10) AS date
            FROM ({DIST_DETAIL}) d LEFT JOIN newest_device n
            ON n.user_type = 'DR' AND CAST(n.user_id AS VARCHAR) = d.driver_id""",
        "latest_device": f"""{_with(FX_DEVICE)} SELECT user_id, user_type, update_time, app_version, os_type
            FROM newest_device WHERE user_type = 'DR'""",
        "attach_versions": f"""{_with(FX_ORDER, FX_EXT)} SELECT {ROW}, driver_version, dt FROM fx_order
            LEFT JOIN (SELECT DISTINCT service_order_id, driver_version FROM fx_ext) USING (service_order_id)
            WHERE {BASIC}""",
        "join_latest_ext": f"""{_with(FX_ORDER, FX_EXT, LATEST_EXT)} SELECT {ROW}, driver_version, runtime,
            predict_distance FROM fx_order JOIN newest_ext USING (service_order_id)""",
        "risk_flag": f"{RISK} SELECT {ROW}, service_order_id IN {risk_ids} AS is_rc FROM fx_order",
        "risk_semi": f"""{RISK} SELECT service_order_id, l_linenumber, dt FROM fx_order
            WHERE service_order_id IN {risk_ids}""",
        "risk_anti": f"""{RISK} SELECT service_order_id, l_linenumber, dt FROM fx_order
            WHERE service_order_id NOT IN {risk_ids}""",
        "attach_device": f"""{devices} SELECT {ROW}, CAST(driver_id AS VARCHAR) AS driver_id, n.os_type,
            n.app_version, n.update_time AS device_update FROM fx_valid
            LEFT JOIN newest_device n ON n.user_type = 'DR' AND n.user_id = driver_id""",
        "attach_distance_log": f"""{SUSPECTS}, {FX_LOG} SELECT CAST(d.service_order_id AS VARCHAR)
            AS service_order_id, r_yy_dis, r_sys_dis, driver_dis, response_dis, is_enable
            FROM dist d LEFT JOIN parsed_log g ON g.service_order_id = CAST(d.service_order_id AS VARCHAR)
              AND g.log_day = {_yyyymmdd('d.end_time')}""",
        "city_label": f"""{ORDERS}, {FX_CITY} SELECT {ROW}, city, coalesce(label, city) AS label
            FROM fx_order LEFT JOIN fx_city ON code = city""",
        "trip_points": f"{TRACK} SELECT service_order_id, event_id, t, latitude, longitude FROM near",
        "trip_points_broken_time": f"""{TRACK} SELECT service_order_id, event_id, t, latitude, longitude
            FROM fx_trip x JOIN fx_point p USING (service_order_id) WHERE p.t BETWEEN x.start_time - 300 AND
              CASE WHEN service_order_id % 3 = 0 THEN x.end_time * 1000 ELSE x.end_time END + 300""",
        "track_class_broken_time": f"""{_with(BROKEN_TRIP_LOST, TRACK_STATS)} SELECT service_order_id,
            {_susp_type('system_distance')} AS susp_type
            FROM fx_trip t LEFT JOIN stats s USING (service_order_id)""",
        "susp_summary": f"""{SUSPECTS} SELECT date, nullif(sum(a), 0)::BIGINT AS distance,
            nullif(sum(b), 0)::BIGINT AS no_start, nullif(sum(c), 0)::BIGINT AS no_end FROM (
              SELECT substr({_clock('start_time')}, 1, 10) AS date, 1 AS a, 0 AS b, 0 AS c FROM dist
              UNION ALL SELECT substr({_clock('start_time')}, 1, 10), 0, (dep_km > sys_km)::INT,
                (dep_km <= sys_km)::INT FROM op) GROUP BY date""",
        "summary_base": f"{_with(FX_ORDER, FX_EXT, SUMMARY_BASE)} SELECT * FROM base",
        "daily_summary": _with(FX_ORDER, FX_EXT, SUMMARY_BASE)
        + _summary("true", "base", "sys_zero", "CAST(0 AS BIGINT)"),
        "daily_summary_rc": _with(FX_ORDER, FX_EXT, FX_RISK, SUMMARY_BASE)
        + _summary(
            "NOT is_rc", f"(SELECT *, service_order_id IN {risk_ids} AS is_rc FROM base)", "no_rc_zero",
            "count(*) FILTER (system_distance = 0 AND NOT is_rc)",
        ),
        "day_base": f"{_with(FX_ORDER, FX_EXT, FX_RISK, DAY_BASE)} SELECT * FROM day_base",
        "zero_totals": f"""{_with(FX_ORDER, FX_EXT, FX_RISK, DAY_BASE)} SELECT count(*) FILTER (is_rc) AS risk,
            count(*) FILTER (system_distance = 0) AS sys_zero,
            count(*) FILTER (system_distance = 0 AND dependable_distance = 0) AS both_zero,
            count(*) FILTER (system_distance = 0 AND dependable_distance = 0 AND NOT is_rc) AS pure_zero
            FROM day_base""",
        "version_stats": f"""{ZERO} SELECT version AS driver_version, count(*) AS cnt FROM (
            SELECT CASE split_part(driver_version, '_', 2) WHEN '1' THEN 'And' || split_part(driver_version, '_', 1)
              WHEN '2' THEN 'iOS' || split_part(driver_version, '_', 1) ELSE 'other' END AS version FROM fx_zero)
            GROUP BY version""",
        "city_stats": f"""{ZERO}, {FX_CITY} SELECT coalesce(label, city) AS city, count(*) AS cnt
            FROM fx_zero LEFT JOIN fx_city ON code = city GROUP BY ALL""",
        "driver_bad_days": f"""{DRIVERS} SELECT driver_id, count(DISTINCT dt) AS acc_zero_days FROM hist
            WHERE zero_cnt > 0 GROUP BY driver_id""",
        "driver_total": f"""{DRIVERS} SELECT driver_id, CAST(sum(total_cnt) AS BIGINT) AS hist_total FROM hist
            GROUP BY driver_id""",
        "driver_stats": f"""{DRIVERS} SELECT driver_id, t.zero_cnt AS today_zero_cnt, t.total_cnt AS today_cnt,
            coalesce(h.days, 0) AS acc_zero_days, CAST(coalesce(h.total, 0) + t.total_cnt AS BIGINT) AS total_cnt
            FROM today t LEFT JOIN (SELECT driver_id, count(DISTINCT dt) AS days, sum(total_cnt) AS total
              FROM hist GROUP BY driver_id) h USING (driver_id)""",
        "driver_state": f"""{DRIVERS} SELECT driver_id, count(*) AS zero_days, CAST(sum(total_cnt) AS BIGINT) AS total_cnt
            FROM (SELECT driver_id, total_cnt FROM hist UNION ALL SELECT driver_id, total_cnt FROM today)
            GROUP BY driver_id""",
        "driver_stats_state": f"""{DRIVERS} SELECT driver_id, t.zero_cnt AS today_zero_cnt, t.total_cnt AS today_cnt,
            coalesce(h.days, 0) AS acc_zero_days, CAST(coalesce(h.total, 0) + t.total_cnt AS BIGINT) AS total_cnt
            FROM today t LEFT JOIN (SELECT driver_id, count(DISTINCT dt) AS days, sum(total_cnt) AS total
              FROM hist GROUP BY driver_id) h USING (driver_id)""",
        "distance_hist": ZERO
        + _hist(_pickup("expect_start_longitude"), "fx_zero", KM_EDGES, KM_LABELS, "start_pos_diff"),
        "distance_hist_as_found": ZERO
        + _hist(_pickup("expect_end_longitude"), "fx_zero", KM_EDGES, KM_LABELS, "start_pos_diff"),
        "hour_hist": f"""{ZERO} SELECT CAST(h AS INTEGER) AS hour, count(start_time) AS cnt
            FROM range(24) AS hours(h) LEFT JOIN fx_zero ON (start_time + 28800) % 86400 // 3600 = h GROUP BY h""",
        "duration_hist": ZERO
        + _hist("(end_time - start_time) / 60", "fx_zero", MIN_EDGES, MIN_LABELS, "duration"),
        "track_avg_interval": f"""{TRACK} SELECT service_order_id,
            CAST((max(t) - min(t)) // count(*) AS BIGINT) AS avg_interval FROM in_trip GROUP BY service_order_id""",
        "track_gaps": f"""{TRACK} SELECT service_order_id, event_id, t, latitude, longitude, gap FROM (
            SELECT *, lead(t) OVER (PARTITION BY service_order_id ORDER BY t, event_id) - t AS gap FROM in_trip)
            WHERE gap IS NOT NULL""",
        "track_gap_bounds": f"""{LOST} SELECT service_order_id,
            CASE WHEN count(g.t) = 0 THEN -1 ELSE min(gap) END AS min_gap,
            CASE WHEN count(g.t) = 0 THEN -1 ELSE max(gap) END AS max_gap
            FROM fx_trip LEFT JOIN gaps g USING (service_order_id) GROUP BY service_order_id""",
        "track_long_gaps": f"""{LOST} SELECT service_order_id, count(gap) AS n_long_gaps,
            coalesce(string_agg(CAST(gap AS VARCHAR), ',' ORDER BY gap DESC), '') AS gaps
            FROM fx_trip LEFT JOIN (SELECT DISTINCT service_order_id, gap FROM gaps WHERE gap > 120)
            USING (service_order_id) GROUP BY service_order_id""",
        "track_positions": f"""{TRACK} SELECT service_order_id,
            count(DISTINCT (latitude, longitude)) AS n_positions FROM in_trip GROUP BY service_order_id""",
        "track_stats": f"""{_with(FX_TRIP_LOST, TRACK_STATS)} SELECT service_order_id, avg_before, avg_in, avg_after,
            min_gap, max_gap, n_long_gaps, n_positions FROM stats""",
        "track_class": f"""{_with(FX_TRIP_LOST, TRACK_STATS)} SELECT service_order_id,
            {_susp_type('system_distance')} AS susp_type
            FROM fx_trip t LEFT JOIN stats s USING (service_order_id)""",
        "latest_ext": f"{_with(FX_EXT, LATEST_EXT)} SELECT * FROM newest_ext",
        "ext_snapshot": f"{_with(FX_EXT, LATEST_EXT)} SELECT * FROM newest_ext",
        "latest_order": f"""{ORDERS} SELECT service_order_id, l_linenumber, update_time, city, driver_id
            FROM fx_order QUALIFY row_number() OVER (PARTITION BY service_order_id {NEWEST}) = 1""",
        "distinct_versions": f"{EXTS} SELECT DISTINCT service_order_id, driver_version FROM fx_ext",
        "risk_upsert": f"""{_with(FX_RISK)} SELECT service_order_id, is_rc,
            CASE WHEN service_order_id % 3 = 0 THEN 20170330 ELSE dt END AS dt FROM fx_risk
            WHERE is_rc = 'T'""",
        "version_label": f"""{EXTS} SELECT service_order_id, driver_version,
            CASE WHEN driver_version NOT LIKE '%\\_%' ESCAPE '\\' THEN 'other'
              WHEN regexp_matches(driver_version, '^[^_]*_1(_|$)') THEN 'And' || split_part(driver_version, '_', 1)
              WHEN regexp_matches(driver_version, '^[^_]*_2(_|$)') THEN 'iOS' || split_part(driver_version, '_', 1)
              ELSE 'other' END AS version FROM fx_ext""",
        "haversine": f"{ORDERS} SELECT {ROW}, {_pickup('expect_start_longitude')} AS km FROM fx_order",
        "epoch_text": f"""{ORDERS} SELECT {ROW},
            CASE WHEN status = 7 THEN {_clock('start_time')} ELSE '' END AS started FROM fx_order""",
        "epoch_day": f"""{ORDERS} SELECT {ROW}, {_yyyymmdd('end_time')} AS end_day,
            CAST((end_time + 28800) % 86400 // 3600 AS INTEGER) AS end_hour FROM fx_order""",
        "bucket_right_closed": f"""{ORDERS} SELECT {ROW}, CAST(CASE WHEN end_time - start_time <= 0 THEN NULL
            WHEN end_time - start_time <= 1200 THEN (end_time - start_time + 59) // 60 - 1 ELSE 20 END AS INTEGER)
            AS bin FROM fx_order""",
        "safe_cast": f"""{_with(FX_LOG)} SELECT TRY_CAST(p[3] AS BIGINT) AS service_order_id,
            TRY_CAST(p[5] AS DOUBLE) AS as_null, coalesce(TRY_CAST(p[5] AS DOUBLE), 0) AS as_zero,
            coalesce(TRY_CAST(p[14] AS BIGINT), 0) AS flag
            FROM (SELECT string_split(value, chr(9)) AS p FROM fx_log)""",
        "json_distance": f"""{EXTS} SELECT service_order_id, update_time, {PREDICTED} AS predict_distance
            FROM fx_ext""",
        "dash_date": f"""{ORDERS} SELECT {ROW},
            strftime(strptime(CAST(dt AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS day FROM fx_order""",
        "date_list": f"""{ORDERS} SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS day,
            CAST(sum(n) AS BIGINT) AS orders FROM (
              SELECT n, unnest(generate_series(last - INTERVAL 9 DAY, last, INTERVAL 1 DAY)) AS d FROM (
                SELECT strptime(CAST(dt AS VARCHAR), '%Y%m%d') AS last, count(*) AS n FROM fx_order GROUP BY ALL))
            GROUP BY ALL""",
        "mark_new": f"""{SUSPECTS} SELECT CAST(service_order_id AS VARCHAR) AS service_order_id, dt,
            20170327 AS execute_date, CASE WHEN service_order_id IN {seen} THEN 0 ELSE 1 END AS is_new FROM dist""",
        "susp_history": f"""{SUSPECTS} SELECT CAST(service_order_id AS VARCHAR) AS service_order_id,
            CASE WHEN service_order_id IN {seen} THEN dt ELSE 20170327 END AS execute_date,
            CASE WHEN service_order_id IN {seen} THEN 0 ELSE 1 END AS is_new FROM dist""",
        "driver_hist": f"""{DRIVERS} SELECT dt, driver_id, zero_cnt, total_cnt FROM hist
            UNION ALL SELECT 20170329, driver_id, zero_cnt, total_cnt FROM today""",
        "tsv_roundtrip": f"""{ORDERS} SELECT {EXTRACT.replace('city,', "CASE WHEN status = 7 THEN city END AS city,")}
            FROM fx_order""",
        "load_dedupe": f"""{ORDERS} SELECT {EXTRACT} FROM fx_order QUALIFY row_number() OVER (
            PARTITION BY service_order_id, update_time ORDER BY l_extendedprice DESC, driver_id DESC) = 1""",
        "partition_overwrite": f"""{ORDERS} SELECT {ROW},
            CASE WHEN dt IN (20170322, 20170327) THEN -1 ELSE system_distance END AS system_distance, dt
            FROM fx_order""",
        "swap_day": f"""{ORDERS}, one AS (SELECT {ROW},
              CASE WHEN dt IN (20170322, 20170327) THEN -1 ELSE system_distance END AS system_distance, dt
              FROM fx_order WHERE dt <> 20170324)
            SELECT * FROM one UNION ALL SELECT * FROM one""",
        "day_complete": f"""{ORDERS} SELECT CAST(dt AS INTEGER) AS dt, CASE WHEN dt <> 20170323 THEN n END AS n
            FROM range(20170320, 20170331) AS days(dt) LEFT JOIN (SELECT dt, count(*) AS n FROM fx_order GROUP BY dt) USING (dt)""",
        "expire_files": f"{ORDERS} SELECT dt, 2::BIGINT AS places, count(*) AS cnt FROM fx_order WHERE dt > 20170324 GROUP BY dt",
        "added_column": f"""{ORDERS} SELECT {ROW}, CASE WHEN dt >= 20170325 THEN city END AS city, dt FROM fx_order""",
        "expire_partitions": f"{ORDERS} {daily} WHERE dt > 20170324 GROUP BY dt",
        "partition_ready": f"""{ORDERS} SELECT DISTINCT CAST(dt + 2 AS INTEGER) AS dt,
            dt + 2 IN (SELECT dt FROM fx_order) AS ready FROM fx_order""",
        "backfill_resumed": f"{ORDERS} SELECT {EXTRACT} FROM fx_order WHERE dt BETWEEN 20170321 AND 20170326",
        "checked_extract": f"""{ORDERS} SELECT CASE l_linenumber WHEN 1 THEN 'service_order_id' WHEN 2 THEN 'dt' ELSE '' END AS column,
            CASE l_linenumber WHEN 1 THEN 'not a bigint' WHEN 2 THEN 'missing' WHEN 3 THEN 'too many columns' ELSE 'good' END AS reason,
            count(*) AS n FROM fx_order GROUP BY ALL""",
        "checked_logs": f"""{_with(FX_LOG)} SELECT count(*) FILTER (length(value) % 9 <> 0) AS good,
            count(*) FILTER (length(value) % 9 = 0) AS bad FROM fx_log""",
        "checked_tracks": f"""{TRACK}, pages AS (SELECT service_order_id, event_id // 50 AS page, count(*) AS n FROM fx_point GROUP BY ALL)
            SELECT CASE page % 20 WHEN 3 THEN 'missing' WHEN 7 THEN 'not a JSON object' WHEN 11 THEN 'empty' ELSE 'points' END AS reason,
              CAST(sum(CASE WHEN page % 20 IN (3, 7, 11) THEN 1 ELSE n END) AS BIGINT) AS n FROM pages GROUP BY ALL""",
        "rerun_empty_day": f"""{ORDERS} SELECT {ROW}, dt FROM fx_order WHERE dt <> 20170325
            UNION ALL SELECT {ROW}, dt FROM fx_order WHERE dt <> 20170325""",
        "load_day": f"{ORDERS} SELECT {EXTRACT} FROM fx_order WHERE dt > 20170322",
        "backfill_range": f"{ORDERS} SELECT {EXTRACT} FROM fx_order WHERE dt BETWEEN 20170321 AND 20170324",
        "read_days": f"""{ORDERS} SELECT {ROW}, dt FROM fx_order WHERE dt IN (20170322, 20170323, 20170324)""",
        "upsert_by_date": f"""{ORDERS} SELECT dt, count(*) AS cnt FROM fx_order
            WHERE dt < 20170327 OR (status = 7 AND passenger_name NOT LIKE '%测试%') GROUP BY dt""",
        "replace_dim": f"""{_with(FX_DEVICE)} SELECT user_id, device_id, user_type, app_version, 20170329 AS dt
            FROM newest_device""",
        "parse_distance_log": f"""{_with(FX_LOG)} SELECT * FROM parsed_log""",
        "parse_tracks": f"""{TRACK} SELECT service_order_id, t, 'gps' AS provider,
            CAST(event_id % 30 AS DOUBLE) AS accuracy, latitude, longitude FROM fx_point
            WHERE event_id // 50 % 20 NOT IN (3, 7, 11)""",
        "report_bundle": f"""{_with(FX_ORDER, FX_EXT, LATEST_EXT, FX_VALID, FX_RISK, FX_CITY, SUMMARY_BASE, DAY_BASE, DRIVER_HIST)},
            zero AS (SELECT * FROM day_base WHERE system_distance = 0 AND dependable_distance = 0 AND NOT is_rc),
            drivers AS (SELECT driver_id, count(*) AS n FROM day_base GROUP BY driver_id
              HAVING count(*) FILTER (system_distance = 0 AND dependable_distance = 0 AND NOT is_rc) > 0),
            km AS ({_hist(_pickup("expect_start_longitude"), "zero", KM_EDGES, KM_LABELS, "item")}),
            minutes AS ({_hist("(end_time - start_time) / 60", "zero", MIN_EDGES, MIN_LABELS, "item")})
            SELECT 'zero_summary' AS sheet, strftime(strptime(CAST(dt AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS item,
              count(*) FILTER (system_distance = 0) AS n FROM base GROUP BY dt
            UNION ALL SELECT 'zero_detail', CAST(service_order_id AS VARCHAR), start_time FROM zero
            UNION ALL SELECT 'zero_version', CASE split_part(driver_version, '_', 2)
              WHEN '1' THEN 'And' || split_part(driver_version, '_', 1)
              WHEN '2' THEN 'iOS' || split_part(driver_version, '_', 1) ELSE 'other' END AS v, count(*) FROM zero GROUP BY v
            UNION ALL SELECT 'zero_city', coalesce(label, city) AS c, count(*) FROM zero
              LEFT JOIN fx_city ON code = city GROUP BY c
            UNION ALL SELECT 'zero_driver', CAST(driver_id AS VARCHAR), CAST(d.n + coalesce(h.total, 0) AS BIGINT)
              FROM drivers d LEFT JOIN (SELECT driver_id, sum(total_cnt) AS total FROM hist GROUP BY driver_id) h
              USING (driver_id)
            UNION ALL SELECT 'zero_pos_diff', item, cnt FROM km
            UNION ALL SELECT 'zero_hour_distribute', CAST(h AS VARCHAR), count(start_time)
              FROM range(24) AS hours(h) LEFT JOIN zero ON (start_time + 28800) % 86400 // 3600 = h GROUP BY h
            UNION ALL SELECT 'zero_order_duration', item, cnt FROM minutes""",
        "susp_detail": _sheet("dist", DIST_DETAIL, "true"),
        "susp_no_start": _sheet("op", OP_DETAIL, 'x."isDeviationPositive" = 1'),
        "susp_no_end": _sheet("op", OP_DETAIL, 'x."isDeviationPositive" = 0'),
    }
