"""Row-sequence operators over per-key time series.

The reference computes these with Python loops while it generates data; here
they are distributed operators over existing readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odometrix.functions.columns import as_timestamp, truncate_time
from odometrix.operators.scan import PREFIX_MIN, PREFIX_SUM, prefix_scan, previous_values


def _start(start: float | int | str | Column) -> Column:
    if isinstance(start, Column):
        return start
    if isinstance(start, str):
        return F.col(start)
    return F.lit(start)


def running_total(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
    delta: str | Column,
    *,
    start: float | int | str | Column = 0,
    tiebreak: str | None = None,
    name: str = "running_total",
    num_blocks: int | None = None,
    method: str = "auto",
) -> DataFrame:
    """W1: ``start + running sum of delta`` per key, rows in ``(order, tiebreak)``
    order, current row included (an odometer from its increments).

    ``start`` is a number or a column that is constant within a key.
    Integral deltas give an exact ``long`` total; a NULL delta counts as 0.
    ``method`` chooses how keys are spread over tasks (see ``prefix_scan``):
    by default hot keys are split into blocks, the rest take a plain window.
    """
    scanned = prefix_scan(
        df, key, order, delta, tiebreak=tiebreak, num_blocks=num_blocks, method=method
    )
    return scanned.withColumn(name, _start(start) + F.col(PREFIX_SUM)).drop(PREFIX_SUM)


def clamped_running_total(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
    delta: str | Column,
    *,
    start: float | int | str | Column = 0,
    floor: float | int = 0,
    tiebreak: str | None = None,
    name: str = "clamped_total",
    num_blocks: int | None = None,
    method: str = "auto",
) -> DataFrame:
    """W2: the level ``x <- max(floor, x + delta)`` per key, from ``x = start``,
    after each row.

    Closed form (Lindley): with ``S`` the running sum of ``start - floor`` plus
    the deltas, ``x = floor + S - least(0, running min of S)``; so it is one
    prefix scan that tracks the sum and its minimum.
    """
    scanned = prefix_scan(
        df, key, order, delta, tiebreak=tiebreak, num_blocks=num_blocks, with_min=True,
        method=method,
    )
    base = _start(start) - F.lit(floor)
    level = F.lit(floor) + (base + F.col(PREFIX_SUM)) - F.least(F.lit(0), base + F.col(PREFIX_MIN))
    return scanned.withColumn(name, level).drop(PREFIX_SUM, PREFIX_MIN)


_PERIODS = {"day", "hour", "week", "month", "year"}


def last_per_period(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    values: Sequence[str],
    *,
    period: str = "day",
    period_name: str | None = None,
    tiebreak: str | None = None,
    last_ts_name: str | None = None,
) -> DataFrame:
    """W3: per key and period, each value from the period's latest reading
    (``last_<v>``), which is what carries into the next period.

    ``max_by`` is an ordinary aggregate with partial aggregation, so a hot
    key costs one partial row per map task, and with a plain timestamp order
    it runs as a hash aggregate. Ties on ``ts`` go to the larger ``tiebreak``
    if one is given; ordering by the (ts, tiebreak) struct needs a sort-based
    aggregate, so pass it only where readings can share a timestamp.
    """
    if period not in _PERIODS:
        raise ValueError(f"period must be one of {sorted(_PERIODS)}")
    keys = [key] if isinstance(key, str) else list(key)
    period_name = period_name or period
    t = as_timestamp(df, ts)
    bucket = F.to_date(t) if period == "day" else truncate_time(df, ts, period)
    ordering = F.struct(t, F.col(tiebreak)) if tiebreak else t
    aggs = [F.max_by(F.col(v), ordering).alias(f"last_{v}") for v in values]
    if last_ts_name:
        aggs.append(F.max(t).alias(last_ts_name))
    return df.groupBy(*keys, bucket.alias(period_name)).agg(*aggs)


def opening_values(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    values: Sequence[str],
    *,
    period: str = "day",
    tiebreak: str | None = None,
    num_blocks: int | None = None,
    method: str = "auto",
) -> DataFrame:
    """W3, the carry: one row per key and period from the key's first to its last
    reading, periods without readings included.

    ``opening_<v>``: the last value of ``v`` that is not NULL in any earlier period
    (NULL at the start); ``closing_<v>``: the last one in the period, or the
    opening value where there is none; ``n_readings``. Readings without a time
    belong to no period.

    Readings shrink to one row per key and period first, by partial aggregation.
    The carry over these is a scan that splits hot keys; a gap's rows are made
    from the row behind it, where there is a gap."""
    if period not in _PERIODS:
        raise ValueError(f"period must be one of {sorted(_PERIODS)}")
    keys = [key] if isinstance(key, str) else list(key)
    t = as_timestamp(df, ts)
    bucket = F.to_date(t) if period == "day" else truncate_time(df, ts, period)
    place = F.struct(t, F.col(tiebreak)) if tiebreak else t
    periods = (
        df.filter(t.isNotNull())
        .groupBy(*keys, bucket.alias(period))
        .agg(
            *[F.max_by(v, F.when(F.col(v).isNotNull(), place)).alias(f"_odx_last_{v}") for v in values],
            F.count(F.lit(1)).alias("n_readings"),
        )
    )
    wanted = {f"opening_{v}": f"_odx_last_{v}" for v in values} | {"_odx_before": period}
    carried = previous_values(
        periods, keys, period, wanted, skip_nulls=True, num_blocks=num_blocks, method=method
    )
    step = F.expr(f"interval 1 {period}")
    gap = F.sequence(F.col("_odx_before") + step, F.col(period), step)
    every = F.when(F.col("_odx_before").isNotNull(), gap).otherwise(F.array(period))
    rows = carried.withColumn("_odx_period", F.explode(every))
    real = F.col("_odx_period") == F.col(period)
    return rows.select(
        *keys,
        F.col("_odx_period").cast(periods.schema[period].dataType).alias(period),
        *[f"opening_{v}" for v in values],
        *[
            F.coalesce(F.when(real, F.col(f"_odx_last_{v}")), F.col(f"opening_{v}")).alias(f"closing_{v}")
            for v in values
        ],
        F.when(real, F.col("n_readings")).otherwise(0).alias("n_readings"),
    )


def missing_periods(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    *,
    period: str = "hour",
    num_blocks: int | None = None,
    method: str = "auto",
) -> DataFrame:
    """S5 per vehicle: the periods between a key's first and last reading in which
    it has none, as (key, period).

    Found from each period's predecessor, so rows are only made where a gap is: no
    product of keys and a spine of periods. Readings without a time count for none."""
    if period not in _PERIODS:
        raise ValueError(f"period must be one of {sorted(_PERIODS)}")
    keys = [key] if isinstance(key, str) else list(key)
    bucket = F.to_date(as_timestamp(df, ts)) if period == "day" else truncate_time(df, ts, period)
    seen = df.select(*keys, bucket.alias(period)).filter(F.col(period).isNotNull()).distinct()
    after = previous_values(seen, keys, period, {"_odx_before": period}, num_blocks=num_blocks, method=method)
    step = F.expr(f"interval 1 {period}")
    gaps = after.filter(F.col("_odx_before") + step < F.col(period))
    kind = seen.schema[period].dataType
    between = F.sequence(F.col("_odx_before") + step, F.col(period) - step, step)
    return gaps.select(*keys, F.explode(between).alias("_odx_gap")).select(
        *keys, F.col("_odx_gap").cast(kind).alias(period)
    )


def distance_travelled(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
    measure: str | Column,
    *,
    tiebreak: str | None = None,
    name: str = "distance",
    num_blocks: int | None = None,
    method: str = "auto",
) -> DataFrame:
    """G7, reset-aware: per key the way a counter has gone, where it may be set
    back to zero, and ``n_resets``. A reading below the one before counts from
    zero; the first reading only starts the count; NULL readings are passed over.

    Unlike ``max - min`` this needs each reading's predecessor, also across the
    block edges of a split hot key."""
    keys = [key] if isinstance(key, str) else list(key)
    m = F.col(measure) if isinstance(measure, str) else measure
    slim = df.select(*keys, order, *([tiebreak] if tiebreak else []), m.alias("_odx_measure"))
    rows = previous_values(
        slim, keys, order, {"_odx_prev": "_odx_measure"}, tiebreak=tiebreak, skip_nulls=True,
        num_blocks=num_blocks, method=method,
    )
    here, before = F.col("_odx_measure"), F.col("_odx_prev")
    way = F.when(here >= before, here - before).when(here < before, here)
    return rows.groupBy(*keys).agg(
        F.coalesce(F.sum(way), F.lit(0)).alias(name), F.count_if(here < before).alias("n_resets")
    )
