"""Hourly time spine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.functions.columns import hour_of


def hourly_spine(
    spark: SparkSession, start: dt.datetime | str, end: dt.datetime | str, *, name: str = "hour"
) -> DataFrame:
    """Every hour from ``start`` to ``end`` inclusive, as ``timestamp_ntz``.

    Days are generated first and each day expands to its hours, so no single
    array is longer than the number of days or 24.
    """
    bounds = spark.range(1).select(
        F.lit(str(start)).cast("timestamp_ntz").alias("lo"),
        F.lit(str(end)).cast("timestamp_ntz").alias("hi"),
    )
    return _expand(bounds, name)


def hourly_spine_for(df: DataFrame, ts: str, *, name: str = "hour") -> DataFrame:
    """Every hour between the first and the last hour that ``df[ts]`` touches."""
    hours = df.select(hour_of(df, ts).alias("h"))
    bounds = hours.agg(
        F.min("h").cast("timestamp_ntz").alias("lo"), F.max("h").cast("timestamp_ntz").alias("hi")
    )
    return _expand(bounds, name)


def _expand(bounds: DataFrame, name: str) -> DataFrame:
    lo = hour_of(bounds, "lo")
    hi = F.col("hi")
    days = bounds.filter(F.col("lo").isNotNull() & F.col("hi").isNotNull()).select(
        lo.alias("lo"),
        hi.alias("hi"),
        F.explode(
            F.sequence(F.to_date(lo), F.to_date(hi), F.expr("INTERVAL 1 DAY"))
        ).alias("day"),
    )
    hours = days.select(
        "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"), "day"
    ).select(
        "lo",
        "hi",
        (F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("h"))).alias(name),
    )
    return hours.filter((F.col(name) >= F.col("lo")) & (F.col(name) <= F.col("hi"))).select(name)
