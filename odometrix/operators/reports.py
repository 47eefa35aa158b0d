"""Business reports over silver/gold tables.

Plan shape shared by the counting reports: the fact side is aggregated per
join key *before* it meets the other side. A key that holds a third of all
rows then collapses to one partial row per map task, and the join sees at
most one row per key from the fact side. Summing the per-key counts after
the join gives exactly ``count(*)`` over the row-level join, duplicates on
the dimension side included (each dimension row receives its key's count).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odometrix.functions.columns import flag_is_set, make_label, safe_corr, trunc_int

_N = "_odx_n"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def breakdowns_by_label(
    dim: DataFrame,
    log: DataFrame,
    key: str | Sequence[str],
    label_cols: Sequence[str],
    *,
    log_filter: Column | None = None,
    dim_filter: Column | None = None,
    sep: str = " ",
    count_name: str = "breakdown_count",
    label_name: str = "vehicle_make_model",
) -> DataFrame:
    """Q1: log rows per ``CONCAT(label_cols)`` of the matching dimension row.

    ``log_filter`` plays the part of ``WHERE type = 'Reactive'``; because it
    rejects the rows an outer join would null-extend, the join is inner.
    A NULL label part gives one NULL-labelled group. No sort: presentation
    (or :func:`top_n`) orders the result.
    """
    keys = _keys(key)
    logs = log if log_filter is None else log.filter(log_filter)
    per_key = logs.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N))
    dims = dim if dim_filter is None else dim.filter(dim_filter)
    dims = dims.select(*keys, make_label(*label_cols, sep=sep).alias(label_name))
    return (
        per_key.join(dims, keys, "inner")
        .groupBy(label_name)
        .agg(F.sum(_N).cast("long").alias(count_name))
        .select(count_name, label_name)
    )


def breakdown_logs(
    dim: DataFrame,
    log: DataFrame,
    key: str | Sequence[str],
    *,
    log_filter: Column | None = None,
    dim_filter: Column | None = None,
) -> DataFrame:
    """Q1's rows: every column of each (filtered) log row's dimension row, then
    the log's columns but the key. Dimension rows without a log are absent, as
    a filter on the log makes the join inner."""
    keys = _keys(key)
    logs = log if log_filter is None else log.filter(log_filter)
    dims = dim if dim_filter is None else dim.filter(dim_filter)
    return dims.join(logs, keys, "inner").select(*dims.columns, *[c for c in log.columns if c not in keys])


def event_count_by_key(
    log: DataFrame,
    key: str | Sequence[str],
    *,
    where: Column | None = None,
    count_name: str = "num_of_repairs",
) -> DataFrame:
    """Q3a: ``count(*)`` of (filtered) log rows per key."""
    rows = log if where is None else log.filter(where)
    return rows.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias(count_name))


def usage_range_by_key(
    readings: DataFrame,
    key: str | Sequence[str],
    measure: str,
    *,
    min_name: str | None = None,
    max_name: str | None = None,
    diff_name: str | None = None,
) -> DataFrame:
    """Q4: min, max and ``max - min`` of a counter per key (NULLs ignored).

    ``max - min`` is the distance travelled only if the counter never resets.
    """
    min_name = min_name or f"min_{measure}"
    max_name = max_name or f"max_{measure}"
    diff_name = diff_name or f"{measure}_diff"
    return (
        readings.groupBy(*_keys(key))
        .agg(F.min(measure).alias(min_name), F.max(measure).alias(max_name))
        .withColumn(diff_name, F.col(max_name) - F.col(min_name))
    )


def repairs_vs_usage(
    log: DataFrame,
    readings: DataFrame,
    key: str | Sequence[str],
    *,
    actions: Sequence[str] = ("Repair", "Replacement"),
    action_col: str = "action_taken",
    measure: str = "mileage",
    keep_zero: bool = False,
    as_int: bool = True,
    count_name: str = "num_of_repairs",
    diff_name: str | None = None,
) -> DataFrame:
    """Q3: repairs and distance per key.

    By default (as in the reference's inner join) keys without a single
    repair are absent; ``keep_zero=True`` keeps every key that has readings
    with a count of 0. ``as_int`` truncates the distance like ``CAST(x AS INT)``.
    Both inputs are aggregated on the same key, so the join between the two
    aggregates reuses their hash partitioning instead of shuffling again.
    """
    keys = _keys(key)
    diff_name = diff_name or f"{measure}_diff"
    repairs = event_count_by_key(
        log, keys, where=F.col(action_col).isin(*actions), count_name=count_name
    )
    usage = usage_range_by_key(readings, keys, measure, diff_name=diff_name).select(*keys, diff_name)
    if keep_zero:
        joined = usage.join(repairs, keys, "left").withColumn(
            count_name, F.coalesce(F.col(count_name), F.lit(0).cast("long"))
        )
    else:
        joined = repairs.join(usage, keys, "inner")
    diff = trunc_int(diff_name) if as_int else F.col(diff_name)
    return joined.select(*keys, count_name, diff.alias(diff_name))


def usage_correlation(df: DataFrame, x: str, y: str, *, name: str = "corr") -> DataFrame:
    """Q10: one row, the Pearson correlation of two columns; NULL for a
    constant column or fewer than two complete rows."""
    return df.agg(safe_corr(x, y).alias(name))


def top_n(
    df: DataFrame,
    by: str,
    label: str | Sequence[str],
    n: int,
    *,
    with_ties: bool = False,
) -> DataFrame:
    """O4: the ``n`` largest rows by ``by``; ties broken by ``label`` ascending.

    ``orderBy(...).limit(n)`` plans as a distributed top-k (each task keeps
    ``n`` rows, the driver merges ``n`` per task). ``with_ties`` keeps every
    row that equals the ``n``-th value; the cutoff is a scalar subquery over
    that same top-k, so no window over the whole table is needed. NULLs come
    last and tie with each other.
    """
    labels = _keys(label)
    order = [F.desc(by), *[F.asc(c) for c in labels]]
    top = df.orderBy(*order).limit(n)
    if not with_ties:
        return top
    cutoff = top.agg(F.min(by)).scalar()
    # A NULL among the n: everything before it is in, and all NULLs tie.
    nulls = top.agg(F.max(F.col(by).isNull())).scalar()
    return df.filter((F.col(by) >= cutoff) | nulls).orderBy(*order)


def flagged_readings_with_tags(
    tags: DataFrame,
    flags: DataFrame,
    on: str | Sequence[str],
    *,
    tag_cols: Sequence[str] = ("climate_tag", "climate_risk"),
    key: str = "vehicle_id",
    flag_col: str = "peak_flag",
) -> DataFrame:
    """Q2a: every set flag beside the tags of its hour; NULL tags are kept.

    The flag filter is applied before the join, so only flagged readings are
    shuffled. Readings whose hour has no tag row are dropped (inner join).
    The tag side has one row per hour -- its size follows the time span, not
    the data volume -- so adaptive execution broadcasts it on its measured
    size and the flagged readings are not shuffled at all.
    """
    on_cols = _keys(on)
    set_flags = flags.filter(flag_is_set(flags, flag_col)).select(*on_cols, key, flag_col)
    return tags.select(*on_cols, *tag_cols).join(set_flags, on_cols, "inner").select(
        *on_cols, *tag_cols, key, flag_col
    )


def abnormalities_by_tag(
    tags: DataFrame,
    flags: DataFrame,
    on: str | Sequence[str],
    *,
    tag_col: str = "climate_tag",
    flag_col: str = "peak_flag",
    count_name: str = "num_of_abnormalities",
) -> DataFrame:
    """Q2: set flags counted per (non-NULL) tag of the hour they fall in.

    Flagged readings are first counted per hour (partial aggregation), then
    joined to the tags, then the hourly counts are summed per tag.
    """
    on_cols = _keys(on)
    per_hour = (
        flags.filter(flag_is_set(flags, flag_col))
        .groupBy(*on_cols)
        .agg(F.count(F.lit(1)).alias(_N))
    )
    tagged = tags.filter(F.col(tag_col).isNotNull()).select(*on_cols, tag_col)
    return (
        per_hour.join(tagged, on_cols, "inner")
        .groupBy(tag_col)
        .agg(F.sum(_N).cast("long").alias(count_name))
    )
