"""Ordered output with positions (O1-O3).

``ORDER BY`` gives ordered files but no positions, and ``row_number`` over the whole
table sorts it in one task. Here rows are ranged over partitions by the order and
that dealing is written once (a range's bounds come from a sample, so dealing anew
could deal differently). Each range is then numbered by itself, and the number of
rows in all ranges before is added: one row per range.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odometrix.session import planned_partitions, shared_dir

_RANGE, _BEFORE = "_odx_range", "_odx_before"


def with_position(df: DataFrame, order: Sequence[Column | str], *, name: str = "position") -> DataFrame:
    """``df`` plus ``name``: each row's place from 1 in the given order. For one
    result whatever the partitions, the order must be total; rows that tie in all
    of it take consecutive places in some order, and stay in one range. Rows come
    back in no particular order; sort by ``name`` to present them."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/odometrix/ranges-{uuid.uuid4().hex}"
    ranged = df.repartitionByRange(planned_partitions(spark), *order)
    ranged.withColumn(_RANGE, F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    up_to = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"))  # one row per range
    before = sizes.select(_RANGE, F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias(_BEFORE))
    inside = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*order))
    placed = rows.withColumn(name, inside).join(F.broadcast(before), _RANGE)
    return placed.withColumn(name, (F.col(name) + F.col(_BEFORE)).cast("long")).drop(_RANGE, _BEFORE)
