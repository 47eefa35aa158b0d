"""Per-key deviation profiles and sigma-based peak flags.

Plan shape: the profile is a ``groupBy`` (partial then final aggregate, so a
hot key costs one partial row per map task) that also counts readings per
key. It is joined back to the readings by an inner join on (key, salt):

* a key with more than one fair partition's worth of readings
  (``n * partitions > total``) is hot. There are at most ``partitions`` such
  keys, so the hot set has a proven bound and is broadcast;
* a hot key gets ``ceil(4 * n * partitions / total)`` salts (see
  ``operators._skew``): each reading takes
  one (a hash of the row, deterministic under retries) and the key's profile
  row is copied once per salt, so the key's readings spread over that many
  join tasks; every other key has salt 0.

This does not depend on adaptive execution: its skew-join rule never fires
here, since an aggregate sits between the profile side of the join and its
shuffle. When the measured profile is small, adaptive execution still
broadcasts it and the readings are not shuffled at all. The one row the
reference's ``profile LEFT JOIN readings`` adds on top of the inner join --
the profile of a NULL key, which matches no reading -- is appended from the
profile itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odometrix.functions.columns import as_timestamp, nan_to_null
from odometrix.operators._skew import COUNT, SALTS, hot_keys, key_counts
from odometrix.session import planned_partitions

SIDES = ("both", "high", "low")


@dataclass(frozen=True)
class FlagRule:
    """One peak flag: ``column`` compared with its key's ``mean +/- k*std``.

    ``side`` is ``both`` (``|x - mean| > k*std``), ``high`` (``x > mean + k*std``)
    or ``low`` (``x < mean - k*std``). ``name`` defaults to ``peak_<stat>``.
    ``stat`` names the profile columns ``mean_<stat>`` / ``std_<stat>`` and
    defaults to the column name.
    """

    column: str
    side: str = "both"
    name: str | None = None
    stat: str | None = None

    def __post_init__(self) -> None:
        if self.side not in SIDES:
            raise ValueError(f"side must be one of {SIDES}, got {self.side!r}")

    @property
    def stat_name(self) -> str:
        return self.stat or self.column

    @property
    def flag_name(self) -> str:
        return self.name or f"peak_{self.stat_name}"


def _rules(metrics: Mapping[str, str] | Sequence[FlagRule | str]) -> list[FlagRule]:
    if isinstance(metrics, Mapping):
        return [FlagRule(c, s) for c, s in metrics.items()]
    return [m if isinstance(m, FlagRule) else FlagRule(m) for m in metrics]


def _stats(metrics: Mapping[str, str] | Sequence[FlagRule | str]) -> dict[str, str]:
    """stat name -> column, in first-seen order."""
    out: dict[str, str] = {}
    for r in _rules(metrics):
        prev = out.setdefault(r.stat_name, r.column)
        if prev != r.column:
            raise ValueError(f"stat {r.stat_name!r} names two columns: {prev!r}, {r.column!r}")
    return out


_N = COUNT  # readings per key
_SALTS = SALTS
_SALT = "_odx_salt"


def _profile_aggs(metrics: Mapping[str, str] | Sequence[FlagRule | str]) -> list:
    aggs = []
    for stat, column in _stats(metrics).items():
        v = nan_to_null(column)
        aggs.append(F.avg(v).alias(f"mean_{stat}"))
        aggs.append(F.stddev_samp(v).alias(f"std_{stat}"))
    return aggs


def deviation_profile(
    df: DataFrame,
    key: str,
    metrics: Mapping[str, str] | Sequence[FlagRule | str],
) -> DataFrame:
    """Q5a: ``key, mean_<m>, std_<m>, ...`` in one pass.

    ``std`` is the sample standard deviation (n-1): NULL for a single reading.
    NaN readings count as NULL.
    """
    return df.groupBy(key).agg(*_profile_aggs(metrics))


def profile_and_counts(
    df: DataFrame, key: str, metrics: Mapping[str, str] | Sequence[FlagRule | str]
) -> tuple[DataFrame, DataFrame]:
    """The profile of :func:`deviation_profile` and the readings per key
    (``key, _odx_n``); pass both to :func:`with_profile`.

    Both come from one aggregate. Left alone, the optimizer would prune and
    filter each use of it differently, and so read the readings once for each.
    The aggregate's row is therefore passed on whole, as the one element of an
    exploded array: every use reads the same aggregate, and Spark runs it once
    and reuses its shuffle. A filter on the key does not reach below it; use
    :func:`deviation_profile` where one should."""
    both = df.groupBy(key).agg(*_profile_aggs(metrics), F.count(F.lit(1)).alias(_N))
    whole = both.select(F.explode(F.array(F.struct(*both.columns))).alias("_odx_row"))
    row = whole.select("_odx_row.*")
    return row.drop(_N), row.select(key, _N)


def with_profile(
    df: DataFrame,
    profile: DataFrame,
    key: str,
    *,
    counts: DataFrame | None = None,
    split_hot_keys: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Q5b: every reading beside its key's profile.

    Columns: all profile columns, then every reading column but the key.
    Rows: as ``profile LEFT JOIN readings`` -- every reading with a non-NULL
    key, plus, if the profile has a NULL key, that profile row with NULL
    reading columns.

    ``counts`` (``key, _odx_n``: readings per key) is computed from ``df``
    when not given. ``split_hot_keys=False`` joins on the key alone.
    ``partitions`` is the fan-out that makes a key hot (by default what the
    session plans for).
    """
    reading_cols = [c for c in df.columns if c != key]
    out_cols = [*profile.columns, *reading_cols]
    if split_hot_keys:
        if counts is None:
            counts = key_counts(df, [key])
        hot = F.broadcast(hot_keys(counts, [key], partitions or _partitions(df)))
        readings = df.join(hot, key, "left").withColumn(
            _SALT,
            F.when(F.col(_SALTS).isNull(), F.lit(0)).otherwise(
                F.pmod(F.xxhash64(*_hashable(df)), F.col(_SALTS)).cast("int")
            ),
        )
        copies = profile.join(hot, key, "left").withColumn(
            _SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1))
        )
        matched = readings.drop(_SALTS).join(copies.drop(_SALTS), [key, _SALT], "inner")
    else:
        matched = df.join(profile, key, "inner")
    null_key = profile.filter(F.col(key).isNull()).select(
        *profile.columns,
        *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in reading_cols],
    )
    return matched.select(*out_cols).unionByName(null_key)


def _hashable(df: DataFrame) -> list:
    """Columns ``xxhash64`` accepts (anything without a map inside)."""
    cols = [F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return cols or [F.lit(0)]


def _partitions(df: DataFrame) -> int:
    return planned_partitions(df.sparkSession)


def deviation_flags(
    df: DataFrame,
    key: str,
    ts: str,
    metrics: Mapping[str, str] | Sequence[FlagRule | str],
    *,
    k: float = 3.0,
    ts_name: str = "converted_timestamp",
    split_hot_keys: bool = True,
) -> DataFrame:
    """Q5: ``key, <ts_name>, <flag>...`` with a 0/1 int flag per rule.

    A reading is compared with the profile of its own key, itself included,
    so a key with ten readings or fewer can never be flagged at k=3. A NULL
    or NaN reading, a NULL std (one reading) and a zero std give 0.
    ``split_hot_keys=False`` skips salting, e.g. when the input is already
    filtered to a few keys.
    """
    rules = _rules(metrics)
    stats = _stats(rules)
    used = {key, ts, *stats.values()}
    readings = df.select(*[c for c in df.columns if c in used])
    if split_hot_keys:
        profile, counts = profile_and_counts(readings, key, rules)
    else:  # filters on the key reach this profile's scan
        profile, counts = deviation_profile(readings, key, rules), None
    joined = with_profile(readings, profile, key, counts=counts, split_hot_keys=split_hot_keys)
    kk = F.lit(float(k))
    flags = []
    for r in rules:
        x = nan_to_null(r.column)
        mean, std = F.col(f"mean_{r.stat_name}"), F.col(f"std_{r.stat_name}")
        if r.side == "both":
            cond = F.abs(x - mean) > kk * std
        elif r.side == "high":
            cond = x > mean + kk * std
        else:
            cond = x < mean - kk * std
        flags.append(F.when(cond, F.lit(1)).otherwise(F.lit(0)).alias(r.flag_name))
    return joined.select(key, as_timestamp(joined, ts).alias(ts_name), *flags)


def engine_temp_flags(
    df: DataFrame,
    *,
    key: str = "vehicle_id",
    ts: str = "timestamp",
    metric: str = "engine_temp",
    side: str = "both",
    k: float = 3.0,
    flag_name: str = "peak_flag",
    split_hot_keys: bool = True,
) -> DataFrame:
    """Q9: ``<ts>, <key>, peak_flag`` -- the single-metric flag table the
    climate report consumes; the timestamp keeps its input type and name."""
    flags = deviation_flags(
        df, key, ts, [FlagRule(metric, side, flag_name)], k=k, ts_name=ts,
        split_hot_keys=split_hot_keys,
    )
    return flags.select(ts, key, flag_name)


def readings_for(df: DataFrame, key: str, value, cols: Sequence[str]) -> DataFrame:
    """Q6: one key's readings, chosen columns. The equality filter is pushed
    below joins and aggregates to the scan."""
    return df.filter(F.col(key) == F.lit(value)).select(*cols)
