"""Raw to silver: flatten the tire struct, type the text
timestamps and dates. Narrow projections only -- no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odometrix.functions.columns import parse_date, parse_timestamp
from odometrix.schemas import WHEELS


def flatten_tires(
    df: DataFrame, struct_col: str = "tire_pressure", wheels: Sequence[str] = WHEELS
) -> DataFrame:
    """P8: ``tire_pressure.front_left`` -> ``front_left_tire_pressure`` (one
    column per wheel, in place of the struct)."""
    out = []
    for c in df.columns:
        if c == struct_col:
            out += [F.col(f"{struct_col}.{w}").alias(f"{w}_{struct_col}") for w in wheels]
        else:
            out.append(F.col(c))
    return df.select(*out)


def to_silver_sensor(raw: DataFrame) -> DataFrame:
    """Typed sensor readings: ``timestamp`` as a timestamp (malformed text ->
    NULL, row kept), tires flattened, fuel level as double."""
    flat = flatten_tires(raw)
    return flat.select(
        "vehicle_id",
        parse_timestamp("timestamp").alias("timestamp"),
        *[f"{w}_tire_pressure" for w in WHEELS],
        "engine_temp",
        "oil_pressure",
        F.col("fuel_level").cast("double").alias("fuel_level"),
        "battery_voltage",
        "mileage",
    )


def to_silver_maintenance(raw: DataFrame) -> DataFrame:
    """Typed maintenance logs: ``date`` as a date (malformed -> NULL)."""
    return raw.withColumn("date", parse_date("date"))


def to_silver_environment(raw: DataFrame) -> DataFrame:
    """Typed hourly weather: ``timestamp`` as a timestamp (malformed -> NULL)."""
    return raw.withColumn("timestamp", parse_timestamp("timestamp"))


def to_silver_fleet(raw: DataFrame) -> DataFrame:
    """Vehicle metadata in a fixed column order (the raw list-of-dict
    inference sorts columns alphabetically)."""
    return raw.select(
        "vehicle_id", "make", "model", "year", "mileage_cap", "vehicle_type",
        "fuel_type", "current_mileage", "assigned_driver", "in_service",
    )
