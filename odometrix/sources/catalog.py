"""The vehicle model catalogue: model -> make, vehicle type.

The raw generator keeps this as a nested Python dict; here it is a small
dimension table joined by make and model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (make, model, vehicle_type), as published by the generator.
MODELS = (
    ("Toyota", "Pilaris", "Van"),
    ("Toyota", "Ero-200", "Bus"),
    ("Toyota", "LinkSwift", "Van"),
    ("Mercedes-Benz", "S900", "Bus"),
    ("Mercedes-Benz", "CX-14", "Van"),
    ("Mercedes-Benz", "L90w", "Bus"),
    ("Audi", "A700", "Van"),
    ("Audi", "AE24", "Bus"),
    ("Audi", "AE26", "Van"),
)


def model_catalog(spark: SparkSession) -> DataFrame:
    """``make, model, vehicle_type``, one row per model."""
    return spark.createDataFrame(list(MODELS), "make string, model string, vehicle_type string")


def with_vehicle_type(
    df: DataFrame,
    catalog: DataFrame,
    *,
    make_col: str = "make",
    model_col: str = "model",
    name: str = "vehicle_type",
) -> DataFrame:
    """Add (or replace) the vehicle type of each row's make and model; unknown
    ones get NULL. ``catalog`` (``make, model, vehicle_type``) must hold a pair
    once; its size decides how Spark joins it."""
    lookup = catalog.select(
        F.col("make").alias("_odx_make"), F.col("model").alias("_odx_model"), F.col("vehicle_type").alias(name)
    )
    base = df.drop(name) if name in df.columns else df
    on = (base[make_col] == lookup["_odx_make"]) & (base[model_col] == lookup["_odx_model"])
    return base.join(lookup, on, "left").drop("_odx_make", "_odx_model")
