"""As-of join: each reading with the last known value of another series (J2/F7).

The reference joins readings to hourly weather on equal times and loses every
reading whose hour has no weather row. Here a reading takes the latest row at or
before it, if that is no older than ``tolerance`` seconds.

No range join: time is cut into buckets of ``tolerance`` seconds, so the row that
a reading takes lies in its own bucket or the one before. Rows of the other series
are copied to both, the two sides are put together, and one window per (keys,
bucket) carries the last row forward. A window therefore never holds more than a
bucket, and a bucket that holds more than one partition's share of the readings is
dealt to several by salt, with the other side copied to each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odometrix.operators._skew import SALTS, hot_keys, key_counts
from odometrix.session import planned_partitions


def _seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since 1970, of the wall clock for a time without zone."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
        return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c))
    return F.unix_seconds(c.cast("timestamp"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    values: Sequence[str],
    *,
    tolerance: int,
    by: Sequence[str] = (),
    as_of: str = "as_of",
    partitions: int | None = None,
) -> DataFrame:
    """Every row of ``left`` with ``values`` and the time (``as_of``) of the latest
    row of ``right`` with equal ``by`` columns and ``right_on <= left_on``, at most
    ``tolerance`` seconds older; NULLs where there is none, or where a ``by``
    column or the time is NULL. Of several such rows at one time the one with the
    largest ``values`` counts. Both times must be of one type."""
    if tolerance < 1:
        raise ValueError("tolerance is in whole seconds, at least one")
    keys = [f"_odx_by{i}" for i in range(len(by))]
    slot, spread = [*keys, "_odx_bucket"], partitions or planned_partitions(left.sparkSession)

    def keyed(df: DataFrame, on: str) -> dict[str, Column]:
        bucket = F.floor(_seconds(df, on) / F.lit(tolerance))
        return {k: F.col(c) for k, c in zip(keys, by)} | {"_odx_bucket": bucket}

    whole = F.struct(*left.columns)
    lefts = left.select(
        whole.alias("_odx_left"),
        F.col(left_on).alias("_odx_t"),
        F.xxhash64(*left.columns).alias("_odx_hash"),
        *[c.alias(k) for k, c in keyed(left, left_on).items()],
    )
    known = F.struct(F.col(right_on).alias("t"), F.struct(*values).alias("v"))
    rights = right.filter(F.col(right_on).isNotNull())
    for c in by:
        rights = rights.filter(F.col(c).isNotNull())
    rights = rights.select(
        known.alias("_odx_right"),
        F.col(right_on).alias("_odx_t"),
        *[c.alias(k) for k, c in keyed(rights, right_on).items() if k != "_odx_bucket"],
        F.explode(F.array(keyed(rights, right_on)["_odx_bucket"], keyed(rights, right_on)["_odx_bucket"] + 1)).alias("_odx_bucket"),
    )

    counts = key_counts(left.select(*[c.alias(k) for k, c in keyed(left, left_on).items()]), slot)
    hot = hot_keys(counts, slot, spread).select(*[F.col(k).alias(f"_odx_h{k}") for k in slot], SALTS)

    def salted(df: DataFrame) -> DataFrame:
        on = [df[k].eqNullSafe(hot[f"_odx_h{k}"]) for k in slot]
        return df.join(F.broadcast(hot), on, "left").drop(*[f"_odx_h{k}" for k in slot])

    n = F.coalesce(SALTS, F.lit(1))
    lefts = salted(lefts).withColumn("_odx_salt", F.pmod("_odx_hash", n).cast("int")).drop(SALTS, "_odx_hash")
    rights = salted(rights).withColumn("_odx_salt", F.explode(F.sequence(F.lit(0), n - 1))).drop(SALTS)

    both = rights.withColumn("_odx_side", F.lit(0)).unionByName(
        lefts.withColumn("_odx_side", F.lit(1)), allowMissingColumns=True
    )
    w = Window.partitionBy(*slot, "_odx_salt").orderBy("_odx_t", "_odx_side", "_odx_right")
    last = F.last("_odx_right", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = both.withColumn("_odx_last", last).filter("_odx_side = 1")
    fresh = F.col("_odx_last.t") + F.make_dt_interval(secs=F.lit(tolerance)) >= F.col("_odx_t")
    return rows.select(
        "_odx_left.*",
        *[F.when(fresh, F.col(f"_odx_last.v.{v}")).alias(v) for v in values],
        F.when(fresh, F.col("_odx_last.t")).alias(as_of),
    )
