"""Catalog and path scans."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# The driver's table names.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def load_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``<base>/<name>.parquet``, or ``<base>/<name>`` where a local folder holds
    the table under that name (a directory of parquet files). Columns are pruned
    and filters pushed into the scan by the optimizer, so callers select what
    they need downstream."""
    path = f"{base}/{name}.parquet"
    if os.path.isdir(os.path.join(base, name)) and not os.path.exists(path):
        path = os.path.join(base, name)
    return spark.read.parquet(path)


def register_tables(
    spark: SparkSession, base: str, names: Iterable[str] = TABLES
) -> dict[str, DataFrame]:
    """Load tables and name them as temp views for SQL."""
    out = {}
    for name in names:
        df = load_table(spark, base, name)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out
