"""The fleet pipeline: raw -> silver -> gold, with the reference's table and
column names (SURVEY 1.4, 3.1-3.3).

Raw sensor JSON, maintenance logs, hourly weather and vehicle metadata are
typed into silver tables; the gold tables answer the three business
questions and flag per-vehicle sensor peaks. Every function here is lazy
except :func:`land_silver` and :func:`save_gold_tables`, which write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.functions.columns import hour_of
from odometrix.operators.ingest import (
    to_silver_environment,
    to_silver_fleet,
    to_silver_maintenance,
    to_silver_sensor,
)
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
    usage_correlation,
    usage_range_by_key,
)
from odometrix.operators.rules import apply_tag_rules
from odometrix.schemas import RAW_ENVIRONMENT, RAW_FLEET, RAW_MAINTENANCE
from odometrix.sources.sensor_json import read_sensor_json
from odometrix.sources.writers import save_gold, write_once

KEY = "vehicle_id"

# The maintenance type that marks a breakdown, the actions
# that count as repairs, and the profile statistics and peak flags of the
# gold sensor table -- (reading column, side, flag name, statistic name) --
# in the reference's column order. Oil pressure is flagged on the high side
# only.
BREAKDOWN_TYPE = "Reactive"
REPAIR_ACTIONS = ("Repair", "Replacement")
PEAK_RULES = (
    FlagRule("battery_voltage", "both", "peak_voltage", "voltage"),
    FlagRule("engine_temp", "both", "peak_temp", "temp"),
    FlagRule("oil_pressure", "high", "peak_pressure", "pressure"),
    FlagRule("front_left_tire_pressure", "both", "peak_fl_tire_pressure", "fl_tire_pressure"),
    FlagRule("front_right_tire_pressure", "both", "peak_fr_tire_pressure", "fr_tire_pressure"),
    FlagRule("rear_left_tire_pressure", "both", "peak_rl_tire_pressure", "rl_tire_pressure"),
    FlagRule("rear_right_tire_pressure", "both", "peak_rr_tire_pressure", "rr_tire_pressure"),
)
# Profile column order of the reference: temp, voltage, pressure, tires.
PROFILE_RULES = (PEAK_RULES[1], PEAK_RULES[0], *PEAK_RULES[2:])


# --- silver --------------------------------------------------------------------


def read_raw(spark: SparkSession, raw_root: str) -> dict[str, DataFrame]:
    """The four raw datasets under ``raw_root`` with declared schemas: a JSON
    sensor drop and three parquet datasets."""
    return {
        "sensor": read_sensor_json(spark, f"{raw_root}/raw_sensor_data"),
        "maintenance": spark.read.schema(RAW_MAINTENANCE).parquet(f"{raw_root}/raw_maintenance_data"),
        "environment": spark.read.schema(RAW_ENVIRONMENT).parquet(f"{raw_root}/raw_environmental_data"),
        "fleet": spark.read.schema(RAW_FLEET).parquet(f"{raw_root}/raw_fleet_metadata"),
    }


def silver_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "silver_sensor_data": to_silver_sensor(raw["sensor"]),
        "silver_fleet_maintenance_logs": to_silver_maintenance(raw["maintenance"]),
        "silver_environmental_data": to_silver_environment(raw["environment"]),
        "silver_fleet_metadata": to_silver_fleet(raw["fleet"]),
    }


def by_day(df: DataFrame, files_per_day: int | None = None, ts: str = "timestamp") -> DataFrame:
    """Readings with their ``date``, dealt for a writer partitioned by date: few
    files a day instead of one for each task and day. By default adaptive execution
    sizes them from the measured shuffle: a large day is split over several tasks,
    small days share one. ``files_per_day`` deals every day to that many."""
    dated = df.withColumn("date", F.to_date(ts))
    if files_per_day is None:
        return dated.hint("rebalance", "date")
    return dated.repartition("date", F.pmod(F.xxhash64(KEY, ts), F.lit(files_per_day)))


def land_silver(
    spark: SparkSession, raw_root: str, silver_root: str, *, files_per_day: int | None = None
) -> dict[str, str]:
    """Type the raw data and land each silver table as parquet once (an
    existing table is left alone). Sensor readings are partitioned by day so
    date filters prune files; see :func:`by_day` for the size of the files."""
    out = {}
    for name, df in silver_tables(read_raw(spark, raw_root)).items():
        path = f"{silver_root}/{name}"
        if name == "silver_sensor_data":
            write_once(by_day(df, files_per_day), path, partition_by=["date"])
        else:
            write_once(df, path)
        out[name] = path
    return out


# --- gold: question 1 ----------------------------------------------------------------


def gold_breakdowns_by_make_model(
    meta: DataFrame, logs: DataFrame, *, where: Column | None = None
) -> DataFrame:
    """Reactive maintenance logs per ``make model``: ``breakdown_count,
    vehicle_make_model``. ``where`` filters the vehicles (e.g. buses only)."""
    return breakdowns_by_label(
        meta,
        logs,
        KEY,
        ["make", "model"],
        log_filter=F.col("type") == BREAKDOWN_TYPE,
        dim_filter=where,
    )


def maintenance_log_by_make(
    meta: DataFrame, logs: DataFrame, *, where: Column | None = None
) -> DataFrame:
    """The reactive logs behind the counts: the vehicle's columns, then the log's."""
    return breakdown_logs(
        meta, logs, KEY, log_filter=F.col("type") == BREAKDOWN_TYPE, dim_filter=where
    )


# --- gold: sensor profile and peaks ---------------------------------------------------


def sensor_readings_mean_std(sensors: DataFrame) -> DataFrame:
    """Per vehicle, mean and sample std of the seven sensor metrics."""
    return deviation_profile(sensors, KEY, PROFILE_RULES)


def sensor_data_with_avg_std(sensors: DataFrame, *, split_hot_keys: bool = True) -> DataFrame:
    """Every reading beside its vehicle's profile."""
    if not split_hot_keys:
        return with_profile(sensors, sensor_readings_mean_std(sensors), KEY, split_hot_keys=False)
    profile, counts = profile_and_counts(sensors, KEY, PROFILE_RULES)
    return with_profile(sensors, profile, KEY, counts=counts)


def sensor_drilldown(
    sensors: DataFrame,
    vehicle_id: str = "V00001",
    cols: Sequence[str] = ("timestamp", "vehicle_id", "front_left_tire_pressure"),
) -> DataFrame:
    """One vehicle's series from the profiled readings (one key: no salting,
    so the vehicle filter reaches every scan)."""
    profiled = sensor_data_with_avg_std(sensors, split_hot_keys=False)
    return readings_for(profiled, KEY, vehicle_id, list(cols))


def gold_sensor_reading_peaks(sensors: DataFrame, *, k: float = 3.0) -> DataFrame:
    """``vehicle_id, converted_timestamp, peak_voltage, peak_temp,
    peak_pressure, peak_{fl,fr,rl,rr}_tire_pressure``."""
    return deviation_flags(sensors, KEY, "timestamp", PEAK_RULES, k=k)


def gold_sensor_engine_temp_with_flags(sensors: DataFrame, *, k: float = 3.0) -> DataFrame:
    """``timestamp, vehicle_id, peak_flag`` for engine temperature."""
    return engine_temp_flags(sensors, key=KEY, ts="timestamp", metric="engine_temp", k=k)


# --- gold: question 2 ----------------------------------------------------------------


def gold_environmental_data_with_risk(
    env: DataFrame, rules: Sequence[tuple[Column, str, str]]
) -> DataFrame:
    """Hourly weather with ``climate_tag, climate_risk`` from caller-supplied
    rules (first match wins). The reference publishes no thresholds."""
    return apply_tag_rules(env, rules)


def _on_the_hour(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumn(ts, hour_of(df, ts))


def engine_temp_with_environmental_data(env_with_risk: DataFrame, flags: DataFrame) -> DataFrame:
    """Set engine-temperature flags beside the weather tags of their hour:
    ``timestamp, climate_tag, climate_risk, vehicle_id, peak_flag``. Both
    timestamps are brought to the hour before the join."""
    return flagged_readings_with_tags(
        _on_the_hour(env_with_risk), _on_the_hour(flags), "timestamp", key=KEY
    )


def gold_engine_abnormalities_by_climate(env_with_risk: DataFrame, flags: DataFrame) -> DataFrame:
    """``climate_tag, num_of_abnormalities``; untagged hours are left out."""
    return abnormalities_by_tag(_on_the_hour(env_with_risk), _on_the_hour(flags), "timestamp")


# --- gold: question 3 ----------------------------------------------------------------


def repairs_by_vehicles(logs: DataFrame) -> DataFrame:
    """``vehicle_id, num_of_repairs``."""
    return event_count_by_key(logs, KEY, where=F.col("action_taken").isin(*REPAIR_ACTIONS))


def mileage_diff_by_vehicle(sensors: DataFrame) -> DataFrame:
    """``vehicle_id, min_mileage, max_mileage, mileage_diff``."""
    return usage_range_by_key(sensors, KEY, "mileage")


def gold_vehicle_logs_by_mile_traveled(
    logs: DataFrame, sensors: DataFrame, *, keep_zero: bool = False
) -> DataFrame:
    """``vehicle_id, num_of_repairs, mileage_diff`` (truncated to int)."""
    return repairs_vs_usage(logs, sensors, KEY, actions=REPAIR_ACTIONS, keep_zero=keep_zero)


def mileage_repairs_correlation(
    logs: DataFrame, sensors: DataFrame, *, keep_zero: bool = False
) -> DataFrame:
    """One row, ``corr``: repairs against miles travelled, per vehicle."""
    both = repairs_vs_usage(
        logs, sensors, KEY, actions=REPAIR_ACTIONS, keep_zero=keep_zero, as_int=False
    )
    return usage_correlation(both, "num_of_repairs", "mileage_diff")


# --- SQL access -----------------------------------------------------------------------


def register_views(
    spark: SparkSession,
    silver_root: str,
    *,
    climate_rules: Sequence[tuple[Column, str, str]] | None = None,
) -> dict[str, DataFrame]:
    """Name the silver tables under ``silver_root`` -- and the gold queries
    built on them -- as temp views, so SQL written against the pipeline's
    table names runs unchanged. Views are lazy: nothing runs here.
    ``climate_rules`` (caller-supplied thresholds) adds the two weather-tag
    views."""
    silver = {
        name: spark.read.parquet(f"{silver_root}/{name}")
        for name in (
            "silver_sensor_data",
            "silver_fleet_maintenance_logs",
            "silver_environmental_data",
            "silver_fleet_metadata",
        )
    }
    sensors = silver["silver_sensor_data"]
    logs = silver["silver_fleet_maintenance_logs"]
    meta = silver["silver_fleet_metadata"]
    views = dict(silver)
    views["gold_breakdowns_by_make_model"] = gold_breakdowns_by_make_model(meta, logs)
    views["gold_sensor_reading_peaks"] = gold_sensor_reading_peaks(sensors)
    views["gold_sensor_engine_temp_with_flags"] = gold_sensor_engine_temp_with_flags(sensors)
    views["gold_vehicle_logs_by_mile_traveled"] = gold_vehicle_logs_by_mile_traveled(logs, sensors)
    views["maintenance_log_by_make"] = maintenance_log_by_make(meta, logs)
    views["sensor_readings_mean_std"] = sensor_readings_mean_std(sensors)
    views["sensor_data_with_avg_std"] = sensor_data_with_avg_std(sensors)
    views["repairs_by_vehicles"] = repairs_by_vehicles(logs)
    views["mileage_diff_by_vehicle"] = mileage_diff_by_vehicle(sensors)
    views["vehicle_logs_by_mile_traveled"] = views["gold_vehicle_logs_by_mile_traveled"]
    if climate_rules:
        env = gold_environmental_data_with_risk(silver["silver_environmental_data"], climate_rules)
        views["gold_environmental_data_with_risk"] = env
        flags = views["gold_sensor_engine_temp_with_flags"]
        views["engine_temp_with_environmental_data"] = engine_temp_with_environmental_data(env, flags)
        views["engine_abnormalities_by_climate"] = gold_engine_abnormalities_by_climate(env, flags)
        views["gold_engine_abnormalities_by_climate"] = views["engine_abnormalities_by_climate"]
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


# --- writing gold ---------------------------------------------------------------------


def save_gold_tables(
    meta: DataFrame,
    logs: DataFrame,
    sensors: DataFrame,
    env_with_risk: DataFrame,
    *,
    prefix: str = "",
) -> list[str]:
    """Materialise the gold tables by name (create or replace). The weather tags
    and the engine flags are saved first, and the climate report reads the
    saved tables instead of deriving them again."""
    spark = sensors.sparkSession
    saved = {
        "gold_environmental_data_with_risk": env_with_risk,
        "gold_sensor_engine_temp_with_flags": gold_sensor_engine_temp_with_flags(sensors),
    }
    for name, df in saved.items():
        save_gold(df, prefix + name)
    env, flags = (spark.table(prefix + name) for name in saved)
    tables = {
        "gold_breakdowns_by_make_model": gold_breakdowns_by_make_model(meta, logs),
        "gold_sensor_reading_peaks": gold_sensor_reading_peaks(sensors),
        "gold_engine_abnormalities_by_climate": gold_engine_abnormalities_by_climate(env, flags),
        "gold_vehicle_logs_by_mile_traveled": gold_vehicle_logs_by_mile_traveled(logs, sensors),
    }
    for name, df in tables.items():
        save_gold(df, prefix + name)
    return [prefix + name for name in (*saved, *tables)]
