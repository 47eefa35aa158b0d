"""Declared schemas of the four raw datasets. Raw data is never schema-inferred."""

from pyspark.sql import types as T

# The wheel names of the tire_pressure struct, in record order.
WHEELS = ("front_left", "front_right", "rear_left", "rear_right")

TIRE_PRESSURE = T.StructType([T.StructField(w, T.DoubleType()) for w in WHEELS])

RAW_SENSOR = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("tire_pressure", TIRE_PRESSURE),
        T.StructField("engine_temp", T.DoubleType()),
        T.StructField("oil_pressure", T.DoubleType()),
        T.StructField("fuel_level", T.DoubleType()),
        T.StructField("battery_voltage", T.DoubleType()),
        T.StructField("mileage", T.DoubleType()),
    ]
)

RAW_MAINTENANCE = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("component_serviced", T.StringType()),
        T.StructField("issue_detected", T.StringType()),
        T.StructField("action_taken", T.StringType()),
        T.StructField("cost", T.DoubleType()),
    ]
)

RAW_ENVIRONMENT = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("highest_wind_speed", T.DoubleType()),
        T.StructField("wind_direction", T.DoubleType()),
        T.StructField("precipitation", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
    ]
)

RAW_FLEET = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("make", T.StringType()),
        T.StructField("year", T.LongType()),
        T.StructField("mileage_cap", T.LongType()),
        T.StructField("vehicle_type", T.StringType()),
        T.StructField("fuel_type", T.StringType()),
        T.StructField("current_mileage", T.LongType()),
        T.StructField("assigned_driver", T.StringType()),
        T.StructField("in_service", T.BooleanType()),
    ]
)

SENSOR_METRICS = (
    "engine_temp",
    "oil_pressure",
    "battery_voltage",
    *(f"{w}_tire_pressure" for w in WHEELS),
)
