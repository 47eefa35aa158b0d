"""Per-key prefix scan that does not put a hot key into one task.

``sum(d) OVER (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING)`` makes
one task read every row of a key; if one key holds a third of the data, one
task does a third of the work. Here every row gets a block that is an explicit
function of its key and order value, and the window runs per (key, block):

1. A key above one partition's fair share of the rows is hot; there are at
   most ``partitions`` of them. Its block bounds are quantiles of its order
   values (one mergeable aggregate); every other key is one block.
2. ``sum`` and ``min`` run over ``Window.partitionBy(key, block)``.
3. Block totals come from an ordinary ``groupBy(key, block)``; a window over
   a key's blocks turns them into the sum (and minimum) of all blocks before.
   Only hot keys have such offsets, at most ``2 * partitions`` rows in all, so
   they are broadcast and added.

Equal order values share a block and blocks follow the order, whatever the
bounds are, so the result does not hang on sampling, exchange reuse, caching
or adaptive execution. All of it is built-in expressions: NULL, NaN, decimal
and overflow behave as in Spark's own window. Long sums are taken as decimals
inside a split key and cast back, so a total that fits never overflows on the
way. Double totals of a split key may differ in the last digits from those of
one window, as any two groupings of a floating sum may.

The order must be total -- pass a unique ``tiebreak`` when ``order`` has
ties -- or equal-order rows may sum in a different order. Order values that
have no quantiles (text, for one) are never split.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odometrix.operators._skew import COUNT, key_counts
from odometrix.session import planned_partitions

PREFIX_SUM = "_odx_sum"
PREFIX_MIN = "_odx_min"
_DELTA, _BLOCK, _BOUNDS, _COARSE = "_odx_d", "_odx_blk", "_odx_bounds", "_odx_coarse"
_SPLIT, _SEEN = "_odx_split", "_odx_seen"
_OFF_SUM, _OFF_MIN = "_odx_osum", "_odx_omin"

METHODS = ("auto", "split", "window")
DEFAULT_BLOCKS = 8  # blocks per key with method="split"
ACCURACY = 10_000  # of the quantiles: blocks are even to one part in this many

_SPLITTABLE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> list[Column]:
    return [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys]


def prefix_scan(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
    delta: Column | str,
    *,
    tiebreak: str | None = None,
    with_min: bool = False,
    method: str = "auto",
    num_blocks: int | None = None,
) -> DataFrame:
    """``df`` plus ``_odx_sum``: the inclusive running sum of ``delta`` per key
    in ``(order, tiebreak)`` order, and with ``with_min`` also ``_odx_min``:
    the running minimum of that running sum. A NULL delta counts as 0. Keys may
    be NULL or NaN (distinct keys, as in Spark); every other column passes
    through unchanged. Rows come back in no particular order.

    ``method``: ``"window"`` is a plain per-key window; ``"auto"`` (default)
    splits hot keys into ``num_blocks`` (by default as many as their share of the
    rows fills partitions); ``"split"`` splits every key.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    keys = [key] if isinstance(key, str) else list(key)
    d = F.col(delta) if isinstance(delta, str) else delta
    kind = df.select(d).schema[0].dataType
    if isinstance(kind, T.IntegralType):
        kind = T.LongType()
    elif not isinstance(kind, T.DecimalType):
        kind = T.DoubleType()
    base = df.withColumn(_DELTA, F.coalesce(d.cast(kind), F.lit(0).cast(kind)))
    if method == "window" or not isinstance(df.schema[order].dataType, _SPLITTABLE):
        return _scanned(base, keys, order, tiebreak, with_min).drop(_DELTA)

    blocked, small = _blocked(base, keys, order, method, num_blocks)

    total = T.LongType() if isinstance(kind, T.LongType) else base.agg(F.sum(_DELTA)).schema[0].dataType
    if isinstance(kind, T.LongType):
        blocked = blocked.withColumn(_DELTA, F.col(_DELTA).cast("decimal(20,0)"))
    rows = _scanned(blocked, [*keys, _BLOCK], order, tiebreak, with_min)
    # Totals of split keys only: without any, their branch is empty and pruned.
    split = blocked.filter(F.col(_SPLIT))
    if with_min:
        split = _scanned(split, [*keys, _BLOCK], order, tiebreak, with_min)
    offsets = _offsets(split, keys, with_min)

    on = [rows[_BLOCK] == offsets["_odx_oblk"], *_same(rows, offsets, keys, "_odx_ok_")]
    out = rows.join(small(offsets), on, "left")
    before = F.coalesce(F.col(_OFF_SUM), F.lit(0))
    whole = (before + F.col(PREFIX_SUM)).cast(total)
    if with_min:
        # The offset of the minimum is NULL before a key's second block.
        out = out.withColumn(PREFIX_MIN, F.least(F.col(_OFF_MIN), before + F.col(PREFIX_MIN)).cast(total))
    out = out.withColumn(PREFIX_SUM, whole)
    return out.drop(_DELTA, _BLOCK, _SPLIT, "_odx_oblk", _OFF_SUM, _OFF_MIN, *[f"_odx_ok_{k}" for k in keys])


def previous_values(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
    values: Mapping[str, Column | str],
    *,
    tiebreak: str | None = None,
    skip_nulls: bool = False,
    method: str = "auto",
    num_blocks: int | None = None,
) -> DataFrame:
    """``df`` plus, for each name in ``values``, that expression's value in the row
    before of the same key in ``(order, tiebreak)`` order, NULL in a key's first
    row; with ``skip_nulls`` the last value that is not NULL in any row before
    (a carry). Rows come back in no particular order.

    Keys are spread as in :func:`prefix_scan`. Inside a block this is a window;
    across the edge of two blocks of a hot key the last value of each block is
    exchanged: one row a block. A NULL ``order`` comes first."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    keys = [key] if isinstance(key, str) else list(key)
    own = {n: f"_odx_own_{i}" for i, n in enumerate(values)}
    base = df.withColumns({own[n]: F.col(e) if isinstance(e, str) else e for n, e in values.items()})
    if method == "window" or not isinstance(df.schema[order].dataType, _SPLITTABLE):
        return _before(base, keys, order, tiebreak, own, skip_nulls).drop(_SEEN, *own.values())

    blocked, small = _blocked(base, keys, order, method, num_blocks)
    rows = _before(blocked, [*keys, _BLOCK], order, tiebreak, own, skip_nulls)
    place = F.struct(order, *([tiebreak] if tiebreak else []))
    lasts = blocked.filter(F.col(_SPLIT)).groupBy(*keys, _BLOCK).agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), place) if skip_nulls else place).alias(f"{c}_last")
            for c in own.values()
        ]
    )
    w = Window.partitionBy(*keys).orderBy(_BLOCK)
    edges = lasts.select(
        F.col(_BLOCK).alias("_odx_oblk"),
        *[F.col(k).alias(f"_odx_ok_{k}") for k in keys],
        *[
            (F.last(f"{c}_last", True).over(w.rowsBetween(Window.unboundedPreceding, -1)) if skip_nulls
             else F.lag(f"{c}_last").over(w)).alias(f"{c}_edge")
            for c in own.values()
        ],
    )
    on = [rows[_BLOCK] == edges["_odx_oblk"], *_same(rows, edges, keys, "_odx_ok_")]
    out = rows.join(small(edges), on, "left")
    for name, c in own.items():
        if skip_nulls:
            out = out.withColumn(name, F.coalesce(name, f"{c}_edge"))
        else:
            out = out.withColumn(name, F.when(F.col(_SEEN), F.col(name)).otherwise(F.col(f"{c}_edge")))
    dropped = [x for c in own.values() for x in (c, f"{c}_edge")]
    return out.drop(_BLOCK, _SPLIT, _SEEN, "_odx_oblk", *dropped, *[f"_odx_ok_{k}" for k in keys])


def _before(base: DataFrame, keys, order, tiebreak, own, skip_nulls) -> DataFrame:
    """Values of the rows before inside the window ``keys``; ``_odx_seen`` where
    there is a row before."""
    w = Window.partitionBy(*keys).orderBy(order, *([tiebreak] if tiebreak else []))
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    found = {n: F.last(c, True).over(earlier) if skip_nulls else F.lag(c).over(w) for n, c in own.items()}
    return base.withColumns({**found, _SEEN: F.lag(F.lit(True), 1, False).over(w)})


def _blocked(base: DataFrame, keys, order, method, num_blocks):
    """``base`` with the block of each row and whether its key is split, and how
    to mark a table with a row per block for the join back: broadcast, as hot
    keys have few blocks, except where every key is split on request."""
    small = F.broadcast if method == "auto" else (lambda table: table)
    bounds = _bounds(base, keys, order, method, num_blocks)
    blocked = base.join(small(bounds), _same(base, bounds, keys, "_odx_hk_"), "left").withColumn(
        _BLOCK, _block(F.col(order))
    )
    blocked = blocked.withColumn(_SPLIT, F.col(_BOUNDS).isNotNull())
    return blocked.drop(_BOUNDS, _COARSE, *[f"_odx_hk_{k}" for k in keys]), small


def _scanned(base: DataFrame, keys, order, tiebreak, with_min) -> DataFrame:
    w = (
        Window.partitionBy(*keys)
        .orderBy(order, *([tiebreak] if tiebreak else []))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = base.withColumn(PREFIX_SUM, F.sum(_DELTA).over(w))
    return out.withColumn(PREFIX_MIN, F.min(PREFIX_SUM).over(w)) if with_min else out


def _bounds(base: DataFrame, keys, order, method, blocks) -> DataFrame:
    """Per key to split: its inner block bounds, sorted, and every k-th of them
    (k about their root), renamed ``_odx_hk_<key>``. At most ``partitions`` keys
    and ``2 * partitions`` bounds for ``"auto"``."""
    parts = planned_partitions(base.sparkSession)
    if method == "split":
        rows, count = base, F.lit(blocks or DEFAULT_BLOCKS)
    else:
        counts = key_counts(base, keys)
        total = counts.agg(F.sum(COUNT)).scalar()
        share = F.col(COUNT) * F.lit(parts)
        hot = counts.filter(share > total).select(
            *[F.col(k).alias(f"_odx_hk_{k}") for k in keys],
            (F.lit(blocks) if blocks else F.ceil(share / total)).cast("int").alias("_odx_m"),
        )
        rows = base.join(F.broadcast(hot), _same(base, hot, keys, "_odx_hk_"), "inner")
        count = F.first("_odx_m")
    # percentile_approx takes constant fractions: a fixed fine grid, of which
    # each key picks as many evenly spaced ones as it has blocks.
    grid = max(2, (blocks or DEFAULT_BLOCKS) if method == "split" else max(parts, blocks or 0))
    picked = rows.groupBy(*keys).agg(
        F.percentile_approx(order, [i / grid for i in range(1, grid)], ACCURACY).alias("_odx_grid"),
        count.alias("_odx_m"),
    )
    even = F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("_odx_m") - 1, F.lit(1))),
        lambda i: F.get("_odx_grid", F.greatest(F.round(i * grid / F.col("_odx_m")).cast("int") - 1, F.lit(0))),
    )
    step = math.isqrt(grid) + 1
    picked = picked.withColumn(_BOUNDS, F.sort_array(F.array_distinct(F.array_compact(even))))
    every = F.filter(F.col(_BOUNDS), lambda _, i: (i + 1) % step == 0)
    return picked.select(
        *[F.col(k).alias(f"_odx_hk_{k}") for k in keys], _BOUNDS, F.struct(F.lit(step).alias("step"), every.alias("b")).alias(_COARSE)
    )


def _block(order: Column) -> Column:
    """How many of the key's bounds lie below the order value (NULL: none; NaN:
    all), found among every k-th bound first, then among the next k."""
    step = F.col(f"{_COARSE}.step")
    skip = F.size(F.filter(F.col(f"{_COARSE}.b"), lambda b: b < order)) * step
    near = F.slice(F.col(_BOUNDS), (skip + 1).cast("int"), step)
    return F.when(F.col(_BOUNDS).isNull(), 0).otherwise(skip + F.size(F.filter(near, lambda b: b < order)))


def _offsets(rows: DataFrame, keys, with_min) -> DataFrame:
    """Sum (and minimum of the running sum) of all blocks before a block, for
    the blocks that have any before them."""
    aggs = [F.sum(_DELTA).alias("_odx_bsum")]
    if with_min:
        aggs.append(F.min(PREFIX_MIN).alias("_odx_bmin"))
    totals = rows.groupBy(*keys, _BLOCK).agg(*aggs)
    before = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn(_OFF_SUM, F.sum("_odx_bsum").over(before))
    names = [_OFF_SUM]
    if with_min:
        reached = F.coalesce(F.col(_OFF_SUM), F.lit(0)) + F.col("_odx_bmin")
        totals = totals.withColumn(_OFF_MIN, F.min(reached).over(before))
        names.append(_OFF_MIN)
    return totals.filter(F.col(_OFF_SUM).isNotNull()).select(
        F.col(_BLOCK).alias("_odx_oblk"), *[F.col(k).alias(f"_odx_ok_{k}") for k in keys], *names
    )
