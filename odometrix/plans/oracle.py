"""DuckDB SQL equal to each query of :mod:`odometrix.plans.driver_tables`.

Written independently of the DataFrame code, with the same parameters.
Engine differences handled here: ``||`` (not DuckDB's NULL-skipping
``concat``), ``CAST(trunc(x) AS INTEGER)`` (DuckDB's cast rounds), single
quotes for strings, sums of bigints cast back to ``BIGINT``.
"""

from __future__ import annotations

from odometrix.plans.driver_tables import (
    CLAMP_SHIFT,
    CLAMP_START,
    FAULT_RANGES,
    LARGE_PART_SIZE,
    LINE_K,
    LINE_METRICS,
    REPAIR_EVENTS,
    RUNNING_START,
    SPOT_USER,
    STALENESS,
    TAG_RULES,
    TIES_OVER_NULLS,
    TOP_N,
)


def r(expr: str, places: int = 4) -> str:
    s = f"CAST({10**places} AS DOUBLE)"
    return f"(floor(({expr}) * {s} + CAST(0.5 AS DOUBLE)) / {s})"


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


HOUR = "CAST(date_trunc('hour', ts) AS TIMESTAMP)"

BREAKDOWNS = """
SELECT count(*) AS breakdown_count, p.p_brand || ' ' || p.p_type AS brand_type
FROM part p JOIN lineitem l ON p.p_partkey = l.l_partkey
WHERE l.l_returnflag = 'R'
GROUP BY p.p_brand || ' ' || p.p_type
"""

LINE_PROFILE = "SELECT l_suppkey, " + ", ".join(
    f"avg({m}) AS mean_{m}, stddev_samp({m}) AS std_{m}" for m in LINE_METRICS
) + " FROM lineitem GROUP BY l_suppkey"


def _line_flag(m: str, side: str) -> str:
    x, mean, std = f"l.{m}", f"p.mean_{m}", f"p.std_{m}"
    cond = {
        "both": f"abs({x} - {mean}) > {LINE_K} * {std}",
        "high": f"{x} > {mean} + {LINE_K} * {std}",
        "low": f"{x} < {mean} - {LINE_K} * {std}",
    }[side]
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END AS peak_{m}"


REPAIRS = f"""
SELECT user_id, count(*) AS num_of_repairs FROM events
WHERE event_type IN ({_in(REPAIR_EVENTS)}) GROUP BY user_id
"""

USAGE = """
SELECT user_id, min(value) AS min_value, max(value) AS max_value,
       max(value) - min(value) AS value_diff
FROM events GROUP BY user_id
"""

PROFILE = """
SELECT user_id, avg(value) AS mean_value, stddev_samp(value) AS std_value
FROM events GROUP BY user_id
"""

FLAG_BOTH = "CASE WHEN abs(e.value - p.mean_value) > 3.0 * p.std_value THEN 1 ELSE 0 END"
FLAG_HIGH = "CASE WHEN e.value > p.mean_value + 3.0 * p.std_value THEN 1 ELSE 0 END"
FLAG_LOW = "CASE WHEN e.value < p.mean_value - 3.0 * p.std_value THEN 1 ELSE 0 END"

HOURLY_FLAGS = f"""
SELECT e.hour, p.user_id, {FLAG_BOTH} AS peak_flag
FROM ({PROFILE}) p
LEFT JOIN (SELECT user_id, value, {HOUR} AS hour FROM events) e ON p.user_id = e.user_id
"""


HOURLY_MEANS = f"""
SELECT {HOUR} AS hour, avg(value) AS mean_value FROM events
WHERE event_type = 'view' AND ts IS NOT NULL GROUP BY 1
"""


def _tag_case(pick: int) -> str:
    whens = " ".join(
        f"WHEN mean_value {op} (SELECT quantile_cont(mean_value, {q}) FROM ({HOURLY_MEANS}) hq) "
        f"THEN '{(tag, risk)[pick]}'"
        for tag, risk, op, q in TAG_RULES
    )
    return f"CASE {whens} END"


HOURLY_TAGS = f"""
SELECT hour, mean_value, {_tag_case(0)} AS climate_tag, {_tag_case(1)} AS climate_risk
FROM ({HOURLY_MEANS}) h
"""


def _status(col: str, lo: float, hi: float) -> str:
    return (
        f"CASE WHEN {col} < {lo} THEN 'low' WHEN {col} > {hi} THEN 'high' "
        f"WHEN {col} IS NOT NULL THEN 'ok' END"
    )


_FAULT_PARTS = ", ".join(
    f"CASE WHEN {_status(c, lo, hi)} <> 'ok' THEN '{c}:' || {_status(c, lo, hi)} END"
    for c, (lo, hi) in FAULT_RANGES.items()
)
FAULTS = f"""
SELECT l_orderkey, l_linenumber,
  {", ".join(f"{_status(c, lo, hi)} AS {c}_status" for c, (lo, hi) in FAULT_RANGES.items())},
  NULLIF(concat_ws(',', {_FAULT_PARTS}), '') AS fault
FROM lineitem
"""

RUN_WINDOW = (
    "PARTITION BY user_id ORDER BY ts, event_id "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
)

ORACLE_SQL: dict[str, str] = {
    "breakdowns_by_label": BREAKDOWNS,
    "breakdowns_by_label_where": f"""
SELECT count(*) AS breakdown_count, p.p_brand || ' ' || p.p_type AS brand_type
FROM part p JOIN lineitem l ON p.p_partkey = l.l_partkey
WHERE l.l_returnflag = 'R' AND p.p_size >= {LARGE_PART_SIZE}
GROUP BY p.p_brand || ' ' || p.p_type
""",
    "top_n": f"""
SELECT * FROM ({BREAKDOWNS}) b ORDER BY breakdown_count DESC, brand_type ASC LIMIT {TOP_N}
""",
    "top_n_with_ties": f"""
SELECT * FROM ({BREAKDOWNS}) b
WHERE breakdown_count >= (SELECT min(breakdown_count) FROM (
  SELECT breakdown_count FROM ({BREAKDOWNS}) b2
  ORDER BY breakdown_count DESC, brand_type ASC LIMIT {TOP_N}) t)
""",
    "event_count_by_key": REPAIRS,
    "usage_range_by_key": USAGE,
    "repairs_vs_usage": f"""
SELECT r.user_id, r.num_of_repairs, CAST(trunc(u.value_diff) AS INTEGER) AS value_diff
FROM ({REPAIRS}) r JOIN ({USAGE}) u ON r.user_id = u.user_id
""",
    "repairs_vs_usage_keep_zero": f"""
SELECT u.user_id, CAST(coalesce(r.num_of_repairs, 0) AS BIGINT) AS num_of_repairs,
       CAST(trunc(u.value_diff) AS INTEGER) AS value_diff
FROM ({USAGE}) u LEFT JOIN ({REPAIRS}) r ON r.user_id = u.user_id
""",
    "usage_correlation": f"""
SELECT {r('''CASE WHEN stddev_pop(x) > 0 AND stddev_pop(y) > 0
       THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END''', 6)} AS corr
FROM (SELECT CAST(r.num_of_repairs AS DOUBLE) AS x, u.value_diff AS y
      FROM ({REPAIRS}) r JOIN ({USAGE}) u ON r.user_id = u.user_id) j
""",
    "deviation_profile": f"""
SELECT user_id, {r('mean_value')} AS mean_value, {r('std_value')} AS std_value FROM ({PROFILE}) p
""",
    "with_profile": f"""
SELECT p.user_id, {r('p.mean_value')} AS mean_value, {r('p.std_value')} AS std_value,
       e.event_id, e.ts, e.event_type, e.value, e.props
FROM ({PROFILE}) p LEFT JOIN events e ON p.user_id = e.user_id
""",
    "deviation_flags": f"""
SELECT p.user_id, e.ts AS converted_timestamp,
       {FLAG_BOTH} AS peak_value, {FLAG_HIGH} AS peak_value_high, {FLAG_LOW} AS peak_value_low
FROM ({PROFILE}) p LEFT JOIN events e ON p.user_id = e.user_id
""",
    "deviation_profile_multi": "SELECT l_suppkey, "
    + ", ".join(f"{r(f'{s}_{m}')} AS {s}_{m}" for m in LINE_METRICS for s in ("mean", "std"))
    + f" FROM ({LINE_PROFILE}) p",
    "deviation_flags_multi": f"""
SELECT p.l_suppkey, l.l_shipdate AS converted_timestamp,
  {_line_flag("l_quantity", "both")}, {_line_flag("l_extendedprice", "both")},
  {_line_flag("l_discount", "high")}, {_line_flag("l_tax", "low")}
FROM ({LINE_PROFILE}) p LEFT JOIN lineitem l ON p.l_suppkey = l.l_suppkey
""",
    "readings_for": f"""
SELECT e.ts, p.user_id, e.value
FROM ({PROFILE}) p LEFT JOIN events e ON p.user_id = e.user_id
WHERE p.user_id = {SPOT_USER}
""",
    "engine_temp_flags": HOURLY_FLAGS,
    "apply_tag_rules": f"""
SELECT hour, {r('mean_value')} AS mean_value, climate_tag, climate_risk FROM ({HOURLY_TAGS}) t
""",
    "flagged_readings_with_tags": f"""
SELECT t.hour, t.climate_tag, t.climate_risk, f.user_id, f.peak_flag
FROM ({HOURLY_TAGS}) t JOIN ({HOURLY_FLAGS}) f ON t.hour = f.hour
WHERE f.peak_flag = 1
""",
    "abnormalities_by_tag": f"""
SELECT t.climate_tag, count(*) AS num_of_abnormalities
FROM ({HOURLY_TAGS}) t JOIN ({HOURLY_FLAGS}) f ON t.hour = f.hour
WHERE f.peak_flag = 1 AND t.climate_tag IS NOT NULL
GROUP BY t.climate_tag
""",
    "range_faults": FAULTS,
    "range_fault_counts": f"""
SELECT fault, count(*) AS num_readings FROM ({FAULTS}) f GROUP BY fault
""",
    "hourly_spine": f"""
SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour
FROM (SELECT min({HOUR}) AS lo, max({HOUR}) AS hi FROM events) b
""",
    "running_total": f"""
SELECT event_id, user_id, ts,
  CAST({RUNNING_START} + sum(CAST(round(value * 100) AS BIGINT)) OVER ({RUN_WINDOW}) AS BIGINT)
    AS running_cents
FROM events
""",
    "clamped_running_total": f"""
SELECT event_id, user_id, ts,
  CAST(s - least(0, min(s) OVER ({RUN_WINDOW})) AS BIGINT) AS level
FROM (SELECT event_id, user_id, ts,
        {CLAMP_START} + sum(CAST(trunc(value) AS INTEGER) - {CLAMP_SHIFT}) OVER ({RUN_WINDOW}) AS s
      FROM events) x
""",
    "last_per_period": """
SELECT user_id, CAST(ts AS DATE) AS day, arg_max(value, ts) AS last_value, max(ts) AS last_ts
FROM events GROUP BY user_id, CAST(ts AS DATE)
""",
}

# The same results by another plan: split running totals, salted join.
ORACLE_SQL["running_total_split"] = ORACLE_SQL["running_total"]
ORACLE_SQL["clamped_running_total_split"] = ORACLE_SQL["clamped_running_total"]
ORACLE_SQL["with_profile_salted"] = ORACLE_SQL["with_profile"]

_SECONDS = "'%Y-%m-%d %H:%M:%S'"

ORACLE_SQL |= {
    "top_n_with_ties_over_nulls": f"""
SELECT p_brand, largest FROM (
  SELECT p_brand, largest, rank() OVER (ORDER BY largest DESC NULLS LAST) AS place
  FROM (SELECT p_brand, max(CASE WHEN p_size = 50 THEN p_size END) AS largest FROM part GROUP BY p_brand) b
) r WHERE place <= {TIES_OVER_NULLS}
""",
    "breakdown_logs": """
SELECT p_partkey AS partkey, p_brand, p_type, p_size, l_orderkey, l_linenumber, l_returnflag
FROM part JOIN lineitem ON p_partkey = l_partkey WHERE l_returnflag = 'R'
""",
    "to_silver_sensor": f"""
SELECT printf('V%05d', l_suppkey) AS vehicle_id,
       CAST(strftime(l_shipdate, {_SECONDS}) AS TIMESTAMP) AS timestamp,
       l_quantity AS front_left_tire_pressure, l_extendedprice AS front_right_tire_pressure,
       l_discount AS rear_left_tire_pressure, l_tax AS rear_right_tire_pressure,
       l_quantity AS engine_temp, l_extendedprice AS oil_pressure,
       CAST(l_linenumber AS DOUBLE) AS fuel_level, l_discount AS battery_voltage, l_tax AS mileage
FROM lineitem
""",
    "hourly_flags_from_text": f"""
SELECT e.event_id, t.hour, t.climate_tag
FROM (SELECT event_id, {HOUR} AS hour FROM events) e JOIN ({HOURLY_TAGS}) t ON e.hour = t.hour
WHERE t.climate_tag IS NOT NULL
""",
    "scalar_rules": f"""
SELECT o_orderkey, printf('D_%05d', o_custkey) AS customer_id,
       strftime(o_orderdate, {_SECONDS}) AS order_time,
       CAST(CASE WHEN o_orderkey % 2 = 0 THEN 5 * o_orderkey
                 WHEN o_orderkey % 4 = 1 THEN 5 * o_orderkey - 5 ELSE 5 * o_orderkey + 5 END AS BIGINT) AS rounded,
       greatest(o_totalprice - 150000, 0) AS above,
       o_orderdate + INTERVAL 9 DAY + INTERVAL 3 HOUR AS later,
       CAST(CAST(o_orderdate AS DATE) + 28 AS DATE) AS due
FROM orders
""",
    "vehicle_type_lookup": f"""
SELECT p.p_partkey, p.p_brand, p.p_type, c.vehicle_type
FROM part p LEFT JOIN (
  SELECT p_brand, p_type, max(p_name) AS vehicle_type FROM part WHERE p_size >= {LARGE_PART_SIZE}
  GROUP BY p_brand, p_type) c ON p.p_brand = c.p_brand AND p.p_type = c.p_type
""",
}

_BEFORE = "OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

ORACLE_SQL |= {
    "opening_values": f"""
WITH p AS (
  SELECT user_id, CAST(ts AS DATE) AS day, arg_max(value, ts) AS last_value, count(*) AS n
  FROM events GROUP BY user_id, CAST(ts AS DATE)
), spine AS (
  SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
  FROM p GROUP BY user_id
), o AS (
  SELECT s.user_id, s.day, p.last_value, coalesce(p.n, 0) AS n_readings,
         last_value(p.last_value IGNORE NULLS) {_BEFORE.replace("day ROWS", "s.day ROWS").replace("BY user_id", "BY s.user_id")} AS opening_value
  FROM spine s LEFT JOIN p ON p.user_id = s.user_id AND p.day = s.day
)
SELECT user_id, day, opening_value, coalesce(last_value, opening_value) AS closing_value, n_readings FROM o
""",
    "distance_travelled": """
SELECT user_id, CAST(coalesce(sum(CASE WHEN m >= prev THEN m - prev WHEN m < prev THEN m END), 0) AS BIGINT) AS cents,
       count(*) FILTER (m < prev) AS n_resets
FROM (SELECT user_id, m, lag(m) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
      FROM (SELECT user_id, ts, event_id, CAST(round(value * 100) AS BIGINT) AS m FROM events) e) x
GROUP BY user_id
""",
    "asof_weather": f"""
SELECT v.event_id, v.ts,
       CASE WHEN v.ts - w.hour <= INTERVAL {STALENESS} SECOND THEN w.mean_error END AS mean_error,
       CASE WHEN v.ts - w.hour <= INTERVAL {STALENESS} SECOND THEN w.hour END AS hour
FROM (SELECT event_id, ts FROM events WHERE event_type = 'view') v
ASOF LEFT JOIN (SELECT {HOUR} AS hour, {r("avg(value)")} AS mean_error
                FROM events WHERE event_type = 'error' GROUP BY {HOUR}) w ON v.ts >= w.hour
""",
    "profile_from_states": ORACLE_SQL["deviation_profile"],
    "incremental_breakdowns": BREAKDOWNS,
    "incremental_usage": ORACLE_SQL["repairs_vs_usage"],
    "save_gold_twice": BREAKDOWNS,
    "write_once_first_wins": BREAKDOWNS,
}
ORACLE_SQL["opening_values_split"] = ORACLE_SQL["opening_values"]
ORACLE_SQL["distance_travelled_split"] = ORACLE_SQL["distance_travelled"]
ORACLE_SQL["asof_weather_salted"] = ORACLE_SQL["asof_weather"]

_SENSOR_ROWS = """
SELECT event_type AS vehicle_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS timestamp,
       value AS front_left_tire_pressure, value AS front_right_tire_pressure, value AS rear_left_tire_pressure,
       value AS rear_right_tire_pressure, value AS engine_temp, value AS oil_pressure, value AS fuel_level,
       value AS battery_voltage, CAST(event_id AS DOUBLE) AS mileage
FROM events
"""
_IS_REPAIR = f"event_type IN ({_in(REPAIR_EVENTS)})"

ORACLE_SQL |= {
    "breakdowns_with_position": f"""
SELECT breakdown_count, brand_type, row_number() OVER (ORDER BY breakdown_count DESC, brand_type) AS position
FROM ({BREAKDOWNS}) b
""",
    "readings_with_position": """
SELECT event_id, user_id, value, row_number() OVER (ORDER BY user_id, value DESC, event_id) AS position FROM events
""",
    "missing_hours": f"""
SELECT s.user_id, s.hour
FROM (SELECT user_id, unnest(generate_series(min({HOUR}), max({HOUR}), INTERVAL 1 HOUR)) AS hour
      FROM events GROUP BY user_id) s
ANTI JOIN (SELECT user_id, {HOUR} AS hour FROM events) e ON e.user_id = s.user_id AND e.hour = s.hour
""",
    "sensor_arrays": _SENSOR_ROWS,
    "sensor_lines": _SENSOR_ROWS,
    "overwrite_last_wins": BREAKDOWNS,
    "to_silver_maintenance": f"""
SELECT printf('V%05d', user_id) AS vehicle_id, CAST(ts AS DATE) AS date,
       CASE WHEN {_IS_REPAIR} THEN 'Reactive' ELSE 'Routine' END AS type, event_type AS component_serviced,
       CASE WHEN {_IS_REPAIR} THEN 'Repair' ELSE 'Inspection' END AS action_taken, {r("value", 2)} AS cost
FROM events
""",
    "to_silver_environment": f"""
SELECT {HOUR} AS timestamp, max(CAST(round(value * 100) AS BIGINT)) / 100 AS temperature,
       min(CAST(round(value * 100) AS BIGINT)) / 100 AS humidity
FROM events GROUP BY {HOUR}
""",
    "to_silver_fleet": f"""
SELECT printf('V%05d', p_partkey) AS vehicle_id, p_brand AS make, p_type AS model, CAST(p_size AS BIGINT) AS year,
       CAST(p_size AS BIGINT) * 1000 AS mileage_cap, 'Truck' AS vehicle_type, 'Diesel' AS fuel_type,
       CAST(p_partkey AS BIGINT) AS current_mileage, printf('D_%05d', p_partkey) AS assigned_driver,
       p_size >= {LARGE_PART_SIZE} AS in_service
FROM part
""",
    "views_usage": f"""
SELECT printf('V%05d', user_id) AS vehicle_id, num_of_repairs, value_diff AS mileage_diff
FROM ({ORACLE_SQL["repairs_vs_usage"]}) u
""",
}
ORACLE_SQL["missing_hours_split"] = ORACLE_SQL["missing_hours"]
