"""Rule-based tags and range faults. Row-level projections:
no shuffle, one codegen'd ``CASE WHEN`` chain per output column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odometrix.functions.columns import nan_to_null

# The nominal sensor ranges of the raw generator (low, high).
# Injected faults (tire 10-20, engine 120-150, battery 9-11, oil 10-15 or
# 70-100) all fall outside them.
NOMINAL_RANGES: dict[str, tuple[float, float]] = {
    "front_left_tire_pressure": (30.0, 35.0),
    "front_right_tire_pressure": (30.0, 35.0),
    "rear_left_tire_pressure": (30.0, 35.0),
    "rear_right_tire_pressure": (30.0, 35.0),
    "engine_temp": (70.0, 100.0),
    "oil_pressure": (20.0, 60.0),
    "battery_voltage": (12.0, 14.0),
}


def apply_tag_rules(
    df: DataFrame,
    rules: Sequence[tuple[Column, str, str]],
    *,
    tag_name: str = "climate_tag",
    risk_name: str = "climate_risk",
) -> DataFrame:
    """Q7: add ``tag`` and ``risk`` from the first rule whose predicate holds.

    ``rules`` is a list of ``(predicate, tag, risk)``; a NULL predicate does
    not match; no match leaves both columns NULL. Thresholds are the
    caller's: there are no default rules.
    """
    if not rules:
        raise ValueError("apply_tag_rules needs at least one rule")
    tag = risk = None
    for pred, t, r in rules:
        tag = F.when(pred, F.lit(t)) if tag is None else tag.when(pred, F.lit(t))
        risk = F.when(pred, F.lit(r)) if risk is None else risk.when(pred, F.lit(r))
    return df.withColumns({tag_name: tag.cast("string"), risk_name: risk.cast("string")})


def range_faults(
    df: DataFrame,
    ranges: Mapping[str, tuple[float, float]],
    *,
    keep: Sequence[str] | None = None,
    status_suffix: str = "_status",
    fault_name: str = "fault",
) -> DataFrame:
    """Q8: per metric ``low`` / ``high`` / ``ok`` (NULL for a NULL or NaN
    reading; both bounds belong to the range), plus ``fault``: the
    out-of-range metrics as ``<metric>:<low|high>`` joined by ``,`` in the
    order of ``ranges``, NULL when there is none."""
    keep = list(df.columns if keep is None else keep)
    statuses, parts = [], []
    for name, (lo, hi) in ranges.items():
        x = nan_to_null(name)
        status = (
            F.when(x < F.lit(lo), F.lit("low"))
            .when(x > F.lit(hi), F.lit("high"))
            .when(x.isNotNull(), F.lit("ok"))
        )
        statuses.append(status.alias(f"{name}{status_suffix}"))
        parts.append(F.when(status != "ok", F.concat(F.lit(f"{name}:"), status)))
    fault = F.concat_ws(",", *parts)
    return df.select(
        *keep, *statuses, F.when(fault != "", fault).alias(fault_name)
    )


def range_fault_counts(
    faults: DataFrame, *, fault_name: str = "fault", count_name: str = "num_readings"
) -> DataFrame:
    """Readings per fault class (the NULL class is the healthy readings)."""
    return faults.groupBy(fault_name).agg(F.count(F.lit(1)).alias(count_name))
