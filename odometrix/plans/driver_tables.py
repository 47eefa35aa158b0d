"""The operators run on the driver's tables.

The fleet domain maps onto the driver's tables like this:

* ``part`` is the vehicle metadata (``p_brand``, ``p_type`` as make and
  model), ``lineitem`` the maintenance log, ``l_returnflag = 'R'`` a
  reactive (unplanned) repair, the part key the vehicle.
* ``events`` are sensor readings: ``user_id`` the vehicle, ``ts`` the reading
  time, ``value`` the measure; ``error``/``purchase`` events are repairs.
* The hourly mean of ``view`` events plays the weather. Its tag thresholds
  are test parameters, not domain rules: hours above the 90th percentile of
  the hourly means are ``high``, below the 10th ``low`` -- quantiles, so that
  every scale of the data has tagged hours.
* ``lineitem`` quantities and discounts are metrics with nominal ranges, and
  its four measures per supplier are a multi-metric sensor profile (they are
  uniform, so the peak flags there use k = 1.5).

Every query reads whole tables; each returns a lazy DataFrame. Float outputs
are rounded the same way in Spark and in the SQL oracle (``floor(x*10^p +
0.5) / 10^p``, bit-identical in both engines) so that the check compares
values, not summation order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.functions.columns import (
    clamp_min,
    format_id,
    hour_of,
    make_label,
    round_half_even,
    shift_date,
    shift_time,
    timestamp_text,
)
from odometrix.operators.asof import asof_join
from odometrix.operators.incremental import DailyPartials, moments, profile_of
from odometrix.operators.ingest import (
    to_silver_environment,
    to_silver_fleet,
    to_silver_maintenance,
    to_silver_sensor,
)
from odometrix.operators.ordering import with_position
from odometrix.operators.profile import (
    FlagRule,
    deviation_flags,
    deviation_profile,
    engine_temp_flags,
    profile_and_counts,
    readings_for,
    with_profile,
)
from odometrix.operators.reports import (
    abnormalities_by_tag,
    breakdown_logs,
    breakdowns_by_label,
    event_count_by_key,
    flagged_readings_with_tags,
    repairs_vs_usage,
    top_n,
    usage_correlation,
    usage_range_by_key,
)
from odometrix.operators.rules import apply_tag_rules, range_fault_counts, range_faults
from odometrix.operators.series import (
    clamped_running_total,
    distance_travelled,
    last_per_period,
    missing_periods,
    opening_values,
    running_total,
)
from odometrix.session import shared_dir
from odometrix.sources.catalog import with_vehicle_type
from odometrix.sources.spine import hourly_spine_for
from odometrix.plans.fleet import register_views
from odometrix.sources.sensor_json import read_sensor_json
from odometrix.sources.tables import load_table
from odometrix.sources.writers import save_gold, write_once, write_overwrite, write_sensor_json

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the mapping.
REPAIR_EVENTS = ("error", "purchase")
TAG_RULES = (("high", "red", ">", 0.9), ("low", "amber", "<", 0.1))  # (tag, risk, op, quantile)
FAULT_RANGES = {"l_quantity": (10.0, 40.0), "l_discount": (0.02, 0.08)}
TOP_N = 10
RUNNING_START = 100000
CLAMP_START = 25
CLAMP_SHIFT = 60
SPOT_USER = 7
LARGE_PART_SIZE = 25  # "where" of the breakdown report: parts of size >= 25
TIES_OVER_NULLS = 24  # of 25 brands, some of which have no part of the largest size
SPLIT_BLOCKS = 7  # every key's running total cut into this many blocks
SALT_FAN_OUT = 100_000  # makes every user hot in the profile join
LINE_METRICS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
STALENESS = 6 * 3600  # seconds for which an hour's weather holds
LINE_K = 1.5  # uniform measures never pass 3 sigma; 1.5 flags a share of them


def r(c: Column | str, places: int = 4) -> Column:
    """Round half up at ``places`` decimals with plain double arithmetic."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10**places)
    return F.floor(c * scale + 0.5) / scale


def _events(spark: SparkSession, d: str) -> DataFrame:
    return load_table(spark, d, "events")


# --- Q1 and top-n -----------------------------------------------------------


def q_breakdowns_by_label(spark: SparkSession, d: str) -> DataFrame:
    part = load_table(spark, d, "part").select(
        F.col("p_partkey").alias("partkey"), "p_brand", "p_type"
    )
    log = load_table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("partkey"), "l_returnflag"
    )
    return breakdowns_by_label(
        part,
        log,
        "partkey",
        ["p_brand", "p_type"],
        log_filter=F.col("l_returnflag") == "R",
        label_name="brand_type",
    )


def q_breakdowns_by_label_where(spark: SparkSession, d: str) -> DataFrame:
    part = load_table(spark, d, "part").select(
        F.col("p_partkey").alias("partkey"), "p_brand", "p_type", "p_size"
    )
    log = load_table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("partkey"), "l_returnflag"
    )
    return breakdowns_by_label(
        part,
        log,
        "partkey",
        ["p_brand", "p_type"],
        log_filter=F.col("l_returnflag") == "R",
        dim_filter=F.col("p_size") >= LARGE_PART_SIZE,
        label_name="brand_type",
    )


def q_top_breakdowns(spark: SparkSession, d: str) -> DataFrame:
    return top_n(q_breakdowns_by_label(spark, d), "breakdown_count", "brand_type", TOP_N)


def q_top_breakdowns_with_ties(spark: SparkSession, d: str) -> DataFrame:
    return top_n(
        q_breakdowns_by_label(spark, d), "breakdown_count", "brand_type", TOP_N, with_ties=True
    )


def q_top_n_with_ties_over_nulls(spark: SparkSession, d: str) -> DataFrame:
    part = load_table(spark, d, "part")
    largest = F.max(F.when(F.col("p_size") == 50, F.col("p_size"))).alias("largest")
    return top_n(part.groupBy("p_brand").agg(largest), "largest", "p_brand", TIES_OVER_NULLS, with_ties=True)


def q_breakdown_logs(spark: SparkSession, d: str) -> DataFrame:
    part = load_table(spark, d, "part").select(
        F.col("p_partkey").alias("partkey"), "p_brand", "p_type", "p_size"
    )
    log = load_table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("partkey"), "l_orderkey", "l_linenumber", "l_returnflag"
    )
    return breakdown_logs(part, log, "partkey", log_filter=F.col("l_returnflag") == "R")


# --- Q3a, Q4, Q3, Q10 --------------------------------------------------------


def q_event_count_by_key(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d)
    return event_count_by_key(ev, "user_id", where=F.col("event_type").isin(*REPAIR_EVENTS))


def q_usage_range_by_key(spark: SparkSession, d: str) -> DataFrame:
    return usage_range_by_key(_events(spark, d), "user_id", "value")


def _repairs_vs_usage(spark: SparkSession, d: str, **kw) -> DataFrame:
    ev = _events(spark, d)
    return repairs_vs_usage(
        ev, ev, "user_id", actions=REPAIR_EVENTS, action_col="event_type", measure="value", **kw
    )


def q_repairs_vs_usage(spark: SparkSession, d: str) -> DataFrame:
    return _repairs_vs_usage(spark, d)


def q_repairs_vs_usage_keep_zero(spark: SparkSession, d: str) -> DataFrame:
    return _repairs_vs_usage(spark, d, keep_zero=True)


def q_usage_correlation(spark: SparkSession, d: str) -> DataFrame:
    both = _repairs_vs_usage(spark, d, as_int=False)
    return usage_correlation(both, "num_of_repairs", "value_diff").select(r("corr", 6).alias("corr"))


# --- Q5a, Q5b, Q5, Q6, Q9 ----------------------------------------------------

VALUE_RULES = (
    FlagRule("value", "both", "peak_value"),
    FlagRule("value", "high", "peak_value_high"),
    FlagRule("value", "low", "peak_value_low"),
)


def q_deviation_profile(spark: SparkSession, d: str) -> DataFrame:
    prof = deviation_profile(_events(spark, d), "user_id", ["value"])
    return prof.select("user_id", r("mean_value").alias("mean_value"), r("std_value").alias("std_value"))


def _with_profile(spark: SparkSession, d: str, *, split_hot_keys: bool = True) -> DataFrame:
    ev = _events(spark, d)
    if not split_hot_keys:
        return with_profile(ev, deviation_profile(ev, "user_id", ["value"]), "user_id", split_hot_keys=False)
    profile, counts = profile_and_counts(ev, "user_id", ["value"])
    return with_profile(ev, profile, "user_id", counts=counts)


def q_with_profile(spark: SparkSession, d: str) -> DataFrame:
    return _with_profile(spark, d).withColumns(
        {"mean_value": r("mean_value"), "std_value": r("std_value")}
    )


def q_with_profile_salted(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d)
    profile, counts = profile_and_counts(ev, "user_id", ["value"])
    out = with_profile(ev, profile, "user_id", counts=counts, partitions=SALT_FAN_OUT)
    return out.withColumns({"mean_value": r("mean_value"), "std_value": r("std_value")})


def q_deviation_flags(spark: SparkSession, d: str) -> DataFrame:
    return deviation_flags(_events(spark, d), "user_id", "ts", VALUE_RULES)


LINE_RULES = (
    FlagRule("l_quantity", "both"),
    FlagRule("l_extendedprice", "both"),
    FlagRule("l_discount", "high"),
    FlagRule("l_tax", "low"),
)


def q_deviation_profile_multi(spark: SparkSession, d: str) -> DataFrame:
    prof = deviation_profile(load_table(spark, d, "lineitem"), "l_suppkey", list(LINE_METRICS))
    return prof.select(
        "l_suppkey",
        *[r(f"{s}_{m}").alias(f"{s}_{m}") for m in LINE_METRICS for s in ("mean", "std")],
    )


def q_deviation_flags_multi(spark: SparkSession, d: str) -> DataFrame:
    li = load_table(spark, d, "lineitem")
    return deviation_flags(li, "l_suppkey", "l_shipdate", LINE_RULES, k=LINE_K)


def q_readings_for(spark: SparkSession, d: str) -> DataFrame:
    # A drill-down reads one key: its filter reaches every scan, and salting
    # (whose hot-key share needs the whole key column) has nothing to split.
    profiled = _with_profile(spark, d, split_hot_keys=False)
    return readings_for(profiled, "user_id", SPOT_USER, ["ts", "user_id", "value"])


def _hourly_flags(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d)
    ev = ev.select("user_id", "value", hour_of(ev, "ts").alias("hour"))
    return engine_temp_flags(ev, key="user_id", ts="hour", metric="value")


def q_engine_temp_flags(spark: SparkSession, d: str) -> DataFrame:
    return _hourly_flags(spark, d)


# --- Q7, Q2a, Q2 -------------------------------------------------------------


def _hourly_tags(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).filter(F.col("event_type") == "view")
    hourly = (
        ev.groupBy(hour_of(ev, "ts").alias("hour"))
        .agg(F.avg("value").alias("mean_value"))
        .filter(F.col("hour").isNotNull())  # an hour is a time; the join side needs it too
    )
    m = F.col("mean_value")
    ops = {">": lambda a, b: a > b, "<": lambda a, b: a < b}
    # Each threshold is an exact percentile of the (one row per hour) table,
    # evaluated once as a scalar subquery.
    rules = [
        (ops[op](m, hourly.agg(F.percentile("mean_value", F.lit(q))).scalar()), tag, risk)
        for tag, risk, op, q in TAG_RULES
    ]
    return apply_tag_rules(hourly, rules)


def q_apply_tag_rules(spark: SparkSession, d: str) -> DataFrame:
    return _hourly_tags(spark, d).withColumn("mean_value", r("mean_value"))


def q_flagged_readings_with_tags(spark: SparkSession, d: str) -> DataFrame:
    return flagged_readings_with_tags(
        _hourly_tags(spark, d), _hourly_flags(spark, d), "hour", key="user_id"
    )


def q_abnormalities_by_tag(spark: SparkSession, d: str) -> DataFrame:
    return abnormalities_by_tag(_hourly_tags(spark, d), _hourly_flags(spark, d), "hour")


# --- Q8 ----------------------------------------------------------------------


def _faults(spark: SparkSession, d: str) -> DataFrame:
    li = load_table(spark, d, "lineitem")
    return range_faults(li, FAULT_RANGES, keep=["l_orderkey", "l_linenumber"])


def q_range_faults(spark: SparkSession, d: str) -> DataFrame:
    return _faults(spark, d)


def q_range_fault_counts(spark: SparkSession, d: str) -> DataFrame:
    return range_fault_counts(_faults(spark, d))


# --- S5, W1, W2, W3 ----------------------------------------------------------


def q_hourly_spine(spark: SparkSession, d: str) -> DataFrame:
    return hourly_spine_for(_events(spark, d), "ts")


def q_running_total(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).select("event_id", "user_id", "ts", "value")
    cents = F.round(F.col("value") * 100).cast("long")
    out = running_total(
        ev, "user_id", "ts", cents, start=RUNNING_START, tiebreak="event_id", name="running_cents"
    )
    return out.select("event_id", "user_id", "ts", "running_cents")


def q_clamped_running_total(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).select("event_id", "user_id", "ts", "value")
    delta = F.col("value").cast("int") - F.lit(CLAMP_SHIFT)
    out = clamped_running_total(
        ev, "user_id", "ts", delta, start=CLAMP_START, tiebreak="event_id", name="level"
    )
    return out.select("event_id", "user_id", "ts", "level")


def q_running_total_split(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).select("event_id", "user_id", "ts", "value")
    cents = F.round(F.col("value") * 100).cast("long")
    out = running_total(
        ev, "user_id", "ts", cents, start=RUNNING_START, tiebreak="event_id", name="running_cents",
        method="split", num_blocks=SPLIT_BLOCKS,
    )
    return out.select("event_id", "user_id", "ts", "running_cents")


def q_clamped_running_total_split(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).select("event_id", "user_id", "ts", "value")
    delta = F.col("value").cast("int") - F.lit(CLAMP_SHIFT)
    out = clamped_running_total(
        ev, "user_id", "ts", delta, start=CLAMP_START, tiebreak="event_id", name="level",
        method="split", num_blocks=SPLIT_BLOCKS,
    )
    return out.select("event_id", "user_id", "ts", "level")


# --- P8, X3, X8-X13, Q11, F7 on text -------------------------------------------


def q_to_silver_sensor(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as raw readings: an id, a text time and a struct of four."""
    li = load_table(spark, d, "lineitem")
    raw = li.select(
        format_id("V", "l_suppkey").alias("vehicle_id"),
        timestamp_text("l_shipdate").alias("timestamp"),
        F.struct(
            F.col("l_quantity").alias("front_left"),
            F.col("l_extendedprice").alias("front_right"),
            F.col("l_discount").alias("rear_left"),
            F.col("l_tax").alias("rear_right"),
        ).alias("tire_pressure"),
        F.col("l_quantity").alias("engine_temp"),
        F.col("l_extendedprice").alias("oil_pressure"),
        F.col("l_linenumber").alias("fuel_level"),
        F.col("l_discount").alias("battery_voltage"),
        F.col("l_tax").alias("mileage"),
    )
    silver = to_silver_sensor(raw)
    return silver.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def q_hourly_flags_from_text(spark: SparkSession, d: str) -> DataFrame:
    """Hours taken from text timestamps, joined to the hourly tags on equality."""
    ev = _events(spark, d)
    text = ev.select("event_id", timestamp_text("ts").alias("ts"))
    hours = text.select("event_id", hour_of(text, "ts").cast("timestamp_ntz").alias("hour"))
    tags = _hourly_tags(spark, d).filter(F.col("climate_tag").isNotNull())
    return hours.join(tags.select("hour", "climate_tag"), "hour").select("event_id", "hour", "climate_tag")


def q_scalar_rules(spark: SparkSession, d: str) -> DataFrame:
    o = load_table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        format_id("D_", "o_custkey").alias("customer_id"),
        timestamp_text("o_orderdate").alias("order_time"),
        round_half_even(F.col("o_orderkey") * 5, -1).cast("long").alias("rounded"),
        clamp_min(F.col("o_totalprice") - 150000.0).alias("above"),
        shift_time("o_orderdate", weeks=1, days=2, hours=3).alias("later"),
        shift_date(F.to_date("o_orderdate"), weeks=4).alias("due"),
    )


def q_vehicle_type_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Brand and type as make and model; the catalogue lacks the small sizes."""
    part = load_table(spark, d, "part")
    catalog = (
        part.filter(F.col("p_size") >= LARGE_PART_SIZE)
        .groupBy(F.col("p_brand").alias("make"), F.col("p_type").alias("model"))
        .agg(F.max("p_name").alias("vehicle_type"))
    )
    parts = part.select("p_partkey", "p_brand", "p_type")
    return with_vehicle_type(parts, catalog, make_col="p_brand", model_col="p_type")


def q_last_per_period(spark: SparkSession, d: str) -> DataFrame:
    # One reading per user and timestamp, as one per vehicle and hour in the
    # fleet data: no tiebreak needed, so the aggregate stays hash-based.
    return last_per_period(_events(spark, d), "user_id", "ts", ["value"], last_ts_name="last_ts")


# --- W3 carry, G7 with resets, J2 as of ------------------------------------------


def q_opening_values(spark: SparkSession, d: str, **kw) -> DataFrame:
    return opening_values(_events(spark, d), "user_id", "ts", ["value"], **kw)


def q_opening_values_split(spark: SparkSession, d: str) -> DataFrame:
    return q_opening_values(spark, d, method="split", num_blocks=SPLIT_BLOCKS)


def q_distance_travelled(spark: SparkSession, d: str, **kw) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("long")
    return distance_travelled(
        _events(spark, d), "user_id", "ts", cents, tiebreak="event_id", name="cents", **kw
    )


def q_distance_travelled_split(spark: SparkSession, d: str) -> DataFrame:
    return q_distance_travelled(spark, d, method="split", num_blocks=SPLIT_BLOCKS)


def q_asof_weather(spark: SparkSession, d: str, **kw) -> DataFrame:
    """Every view with the last hourly weather (made of the rarer errors, so that
    hours are missing) of the last six hours."""
    ev = _events(spark, d)
    errors = ev.filter(F.col("event_type") == "error")
    weather = errors.groupBy(hour_of(errors, "ts").alias("hour")).agg(r(F.avg("value")).alias("mean_error"))
    views = ev.filter(F.col("event_type") == "view").select("event_id", "ts")
    return asof_join(views, weather, "ts", "hour", ["mean_error"], tolerance=STALENESS, as_of="hour", **kw)


def q_asof_weather_salted(spark: SparkSession, d: str) -> DataFrame:
    return q_asof_weather(spark, d, partitions=SALT_FAN_OUT)


# --- Q5a, Q1, Q3 kept up to date; K2, K3 ------------------------------------------


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/odometrix/{label}-{uuid.uuid4().hex}"


def _with_late_days(store: DailyPartials, rows: DataFrame, late: Column, partials: Callable) -> None:
    """First what came in time; then the days of the late rows, each read whole."""
    store.replace(partials(rows.filter(~late)))
    days = rows.filter(late).select(store.day).distinct()
    store.replace(partials(rows.join(days, store.day, "left_semi")))


def q_profile_from_states(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).withColumn("day", F.to_date("ts"))
    store = DailyPartials(spark, _scratch(spark, "moments"), ["user_id"], {"value": "moments"})
    _with_late_days(
        store, ev, F.col("event_type") == "error", lambda rows: moments(rows, ["user_id", "day"], ["value"])
    )
    prof = profile_of(store.merged(), ["user_id"], ["value"])
    return prof.select("user_id", r("mean_value").alias("mean_value"), r("std_value").alias("std_value"))


def q_incremental_breakdowns(spark: SparkSession, d: str) -> DataFrame:
    """Counts per part and month of shipping; parts get their labels at the end."""
    log = load_table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").alias("partkey"), "l_linenumber", F.trunc(F.to_date("l_shipdate"), "month").alias("day")
    )
    store = DailyPartials(spark, _scratch(spark, "breakdowns"), ["partkey"], {"n": "sum"})
    _with_late_days(
        store, log, F.col("l_linenumber") == 1,
        lambda rows: rows.groupBy("partkey", "day").agg(F.count(F.lit(1)).alias("n")),
    )
    part = load_table(spark, d, "part").select(
        F.col("p_partkey").alias("partkey"), make_label("p_brand", "p_type").alias("brand_type")
    )
    labelled = store.merged().join(part, "partkey")
    return labelled.groupBy("brand_type").agg(F.sum("n").alias("breakdown_count"))


def q_incremental_usage(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).withColumn("day", F.to_date("ts"))
    store = DailyPartials(
        spark, _scratch(spark, "usage"), ["user_id"], {"repairs": "sum", "low": "min", "high": "max"}
    )
    _with_late_days(
        store, ev, F.col("event_type") == "purchase",
        lambda rows: rows.groupBy("user_id", "day").agg(
            F.count_if(F.col("event_type").isin(*REPAIR_EVENTS)).alias("repairs"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        ),
    )
    return store.merged().filter("repairs > 0").select(
        "user_id",
        F.col("repairs").alias("num_of_repairs"),
        (F.col("high") - F.col("low")).cast("int").alias("value_diff"),
    )


def q_save_gold_twice(spark: SparkSession, d: str) -> DataFrame:
    """A named table, saved with the large parts' counts, then replaced by all."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS odx_check LOCATION '{shared_dir(spark)}/odometrix/odx_check'")
    name = f"odx_check.breakdowns_{uuid.uuid4().hex}"
    save_gold(q_breakdowns_by_label_where(spark, d), name)
    save_gold(q_breakdowns_by_label(spark, d), name)
    return spark.table(name)


def q_write_once_first_wins(spark: SparkSession, d: str) -> DataFrame:
    path = _scratch(spark, "once")
    write_once(q_breakdowns_by_label(spark, d), path)
    write_once(q_breakdowns_by_label_where(spark, d), path)
    return spark.read.parquet(path)


# --- O1-O3 positions, S5 gaps ------------------------------------------------------


def q_breakdowns_with_position(spark: SparkSession, d: str) -> DataFrame:
    return with_position(q_breakdowns_by_label(spark, d), [F.col("breakdown_count").desc(), "brand_type"])


def q_readings_with_position(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).select("event_id", "user_id", "value")
    return with_position(ev, ["user_id", F.col("value").desc(), "event_id"])


def q_missing_hours(spark: SparkSession, d: str, **kw) -> DataFrame:
    return missing_periods(_events(spark, d), "user_id", "ts", **kw)


def q_missing_hours_split(spark: SparkSession, d: str) -> DataFrame:
    return q_missing_hours(spark, d, method="split", num_blocks=SPLIT_BLOCKS)


# --- S1, S3, K1, K4, K5 and the other silver tables: written to shared storage, read back


def _raw_sensor(ev: DataFrame) -> DataFrame:
    """Events as raw readings; the event type is the vehicle."""
    value = F.col("value")
    wheels = F.struct(*[value.alias(w) for w in ("front_left", "front_right", "rear_left", "rear_right")])
    return ev.select(
        F.col("event_type").alias("vehicle_id"),
        timestamp_text("ts").alias("timestamp"),
        wheels.alias("tire_pressure"),
        *[value.alias(c) for c in ("engine_temp", "oil_pressure", "fuel_level", "battery_voltage")],
        F.col("event_id").cast("double").alias("mileage"),
    )


def _ntz(df: DataFrame, name: str = "timestamp") -> DataFrame:
    return df.withColumn(name, F.col(name).cast("timestamp_ntz"))


def q_sensor_arrays(spark: SparkSession, d: str) -> DataFrame:
    """One file with an array of readings per vehicle and day, as the generator
    writes them, scanned and typed."""
    path = _scratch(spark, "arrays")
    raw = _raw_sensor(_events(spark, d))
    files = raw.groupBy(F.col("vehicle_id").alias("v"), F.substring("timestamp", 1, 10).alias("day")).agg(
        F.to_json(F.collect_list(F.struct(*raw.columns))).alias("value")
    )
    files.repartition("v", "day").write.partitionBy("v", "day").text(path)
    return _ntz(to_silver_sensor(read_sensor_json(spark, path)))


def q_sensor_lines(spark: SparkSession, d: str) -> DataFrame:
    path = _scratch(spark, "lines")
    write_sensor_json(_raw_sensor(_events(spark, d)), path)
    return _ntz(to_silver_sensor(read_sensor_json(spark, path, multi_line=False)))


def q_overwrite_last_wins(spark: SparkSession, d: str) -> DataFrame:
    path = _scratch(spark, "over")
    write_overwrite(q_breakdowns_by_label_where(spark, d), path)
    write_overwrite(q_breakdowns_by_label(spark, d), path)
    return spark.read.parquet(path)


def _raw_maintenance(ev: DataFrame) -> DataFrame:
    repair = F.col("event_type").isin(*REPAIR_EVENTS)
    return ev.select(
        format_id("V", "user_id").alias("vehicle_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.when(repair, "Reactive").otherwise("Routine").alias("type"),
        F.col("event_type").alias("component_serviced"),
        F.lit(None).cast("string").alias("issue_detected"),
        F.when(repair, "Repair").otherwise("Inspection").alias("action_taken"),
        F.col("value").alias("cost"),
    )


def q_to_silver_maintenance(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw_maintenance(_events(spark, d)).withColumn("cost", r("cost", 2))
    return to_silver_maintenance(raw.drop("issue_detected"))


def _raw_environment(ev: DataFrame) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("long")
    return ev.groupBy(F.date_format("ts", "yyyy-MM-dd HH:00:00").alias("timestamp")).agg(
        (F.max(cents) / 100).alias("temperature"), (F.min(cents) / 100).alias("humidity")
    )


def q_to_silver_environment(spark: SparkSession, d: str) -> DataFrame:
    return _ntz(to_silver_environment(_raw_environment(_events(spark, d))))


def _raw_fleet(part: DataFrame) -> DataFrame:
    return part.select(
        format_id("V", "p_partkey").alias("vehicle_id"),
        F.col("p_type").alias("model"),
        F.col("p_brand").alias("make"),
        F.col("p_size").cast("long").alias("year"),
        (F.col("p_size").cast("long") * 1000).alias("mileage_cap"),
        F.lit("Truck").alias("vehicle_type"),
        F.lit("Diesel").alias("fuel_type"),
        F.col("p_partkey").cast("long").alias("current_mileage"),
        format_id("D_", "p_partkey").alias("assigned_driver"),
        (F.col("p_size") >= LARGE_PART_SIZE).alias("in_service"),
    )


def q_to_silver_fleet(spark: SparkSession, d: str) -> DataFrame:
    return to_silver_fleet(_raw_fleet(load_table(spark, d, "part")))


def q_views_usage(spark: SparkSession, d: str) -> DataFrame:
    """SQL over the pipeline's named views: silver tables made of the events."""
    root, ev = _scratch(spark, "silver"), _events(spark, d)
    sensor = _raw_sensor(ev.withColumn("event_type", format_id("V", "user_id")))
    silver = {
        "silver_sensor_data": to_silver_sensor(sensor.withColumn("mileage", F.col("engine_temp"))),
        "silver_fleet_maintenance_logs": to_silver_maintenance(_raw_maintenance(ev)),
        "silver_environmental_data": to_silver_environment(_raw_environment(ev)),
        "silver_fleet_metadata": to_silver_fleet(_raw_fleet(load_table(spark, d, "part"))),
    }
    for name, df in silver.items():
        write_once(df, f"{root}/{name}")
    register_views(spark, root)
    return spark.sql("SELECT vehicle_id, num_of_repairs, mileage_diff FROM gold_vehicle_logs_by_mile_traveled")


QUERIES: dict[str, Query] = {
    "breakdowns_by_label": q_breakdowns_by_label,
    "breakdowns_by_label_where": q_breakdowns_by_label_where,
    "top_n": q_top_breakdowns,
    "top_n_with_ties": q_top_breakdowns_with_ties,
    "top_n_with_ties_over_nulls": q_top_n_with_ties_over_nulls,
    "breakdown_logs": q_breakdown_logs,
    "event_count_by_key": q_event_count_by_key,
    "usage_range_by_key": q_usage_range_by_key,
    "repairs_vs_usage": q_repairs_vs_usage,
    "repairs_vs_usage_keep_zero": q_repairs_vs_usage_keep_zero,
    "usage_correlation": q_usage_correlation,
    "deviation_profile": q_deviation_profile,
    "with_profile": q_with_profile,
    "with_profile_salted": q_with_profile_salted,
    "deviation_flags": q_deviation_flags,
    "deviation_profile_multi": q_deviation_profile_multi,
    "deviation_flags_multi": q_deviation_flags_multi,
    "readings_for": q_readings_for,
    "engine_temp_flags": q_engine_temp_flags,
    "apply_tag_rules": q_apply_tag_rules,
    "flagged_readings_with_tags": q_flagged_readings_with_tags,
    "abnormalities_by_tag": q_abnormalities_by_tag,
    "range_faults": q_range_faults,
    "range_fault_counts": q_range_fault_counts,
    "hourly_spine": q_hourly_spine,
    "running_total": q_running_total,
    "clamped_running_total": q_clamped_running_total,
    "running_total_split": q_running_total_split,
    "clamped_running_total_split": q_clamped_running_total_split,
    "last_per_period": q_last_per_period,
    "to_silver_sensor": q_to_silver_sensor,
    "hourly_flags_from_text": q_hourly_flags_from_text,
    "scalar_rules": q_scalar_rules,
    "vehicle_type_lookup": q_vehicle_type_lookup,
    "opening_values": q_opening_values,
    "opening_values_split": q_opening_values_split,
    "distance_travelled": q_distance_travelled,
    "distance_travelled_split": q_distance_travelled_split,
    "asof_weather": q_asof_weather,
    "asof_weather_salted": q_asof_weather_salted,
    "profile_from_states": q_profile_from_states,
    "incremental_breakdowns": q_incremental_breakdowns,
    "incremental_usage": q_incremental_usage,
    "save_gold_twice": q_save_gold_twice,
    "write_once_first_wins": q_write_once_first_wins,
    "breakdowns_with_position": q_breakdowns_with_position,
    "readings_with_position": q_readings_with_position,
    "missing_hours": q_missing_hours,
    "missing_hours_split": q_missing_hours_split,
    "sensor_arrays": q_sensor_arrays,
    "sensor_lines": q_sensor_lines,
    "overwrite_last_wins": q_overwrite_last_wins,
    "to_silver_maintenance": q_to_silver_maintenance,
    "to_silver_environment": q_to_silver_environment,
    "to_silver_fleet": q_to_silver_fleet,
    "views_usage": q_views_usage,
}
