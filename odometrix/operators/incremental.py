"""Reports and profiles kept up to date day by day (Q1, Q2, Q3, Q5a).

Each day has its own partial in a table partitioned by day: counts and extremes
per key (:class:`DailyPartials`), or the moments of each metric (:func:`moments`).
A day, new or late, replaces its own partial by dynamic partition overwrite and
reads nothing but that day's rows; the report merges the partials. Replays in any
order and any number give the same report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.functions.columns import nan_to_null

_MERGES = {"sum": F.sum, "min": F.min, "max": F.max}


class DailyPartials:
    """Partials of one aggregate at ``path``: ``keys``, the date column ``day`` and
    columns with the way to merge them (``sum``, ``min``, ``max``, or ``moments``
    for the columns of a metric's :func:`moments`)."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], merges: Mapping[str, str], day: str = "day"):
        bad = set(merges.values()) - set(_MERGES) - {"moments"}
        if bad:
            raise ValueError(f"unknown merges {sorted(bad)}")
        self.spark, self.path, self.keys, self.merges, self.day = spark, path, list(keys), dict(merges), day

    def _columns(self) -> list[str]:
        out = [*self.keys]
        for c, how in self.merges.items():
            out += [f"{s}_{c}" for s in ("n", "mean", "m2")] if how == "moments" else [c]
        return out

    def replace(self, partials: DataFrame, days: Sequence[str] | None = None) -> None:
        """Put the partials of the days that ``partials`` has in place of what is
        stored for them. ``days`` (ISO dates) names the days that were read: those
        of them without rows lose their partial, and rows of other days are an
        error. Rows without a day belong to none and are left out."""
        rows = partials.select(*self._columns(), F.col(self.day).cast("date").alias(self.day))
        rows = rows.filter(F.col(self.day).isNotNull())
        if days is not None:
            known = F.col(self.day).isin([F.lit(d).cast("date") for d in days])
            message = F.concat(F.lit("partials of a day that was not named: "), F.col(self.day).cast("string"))
            rows = rows.withColumn(self.day, F.when(known, F.col(self.day)).otherwise(F.raise_error(message).cast("date")))
        # A day's partial is an aggregate, so one task a day is small; many keys split it.
        (
            rows.hint("rebalance", self.day)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.day)
            .parquet(self.path)
        )
        if days is not None:
            written = {str(r[0]) for r in partials.select(F.col(self.day).cast("date")).distinct().collect()}
            for d in set(days) - written:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.day}={d}")
                fs = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
                fs.delete(folder, True)

    def stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def merged(self, by: Sequence[str] | None = None) -> DataFrame:
        """The partials merged per ``by`` (by default all keys)."""
        by = list(self.keys if by is None else by)
        plain = [_MERGES[how](c).alias(c) for c, how in self.merges.items() if how != "moments"]
        metrics = [c for c, how in self.merges.items() if how == "moments"]
        if not metrics:
            return self.stored().groupBy(*by).agg(*plain)
        return merge_moments(self.stored(), by, metrics, plain)


def moments(df: DataFrame, by: Sequence[str | Column], metrics: Sequence[str]) -> DataFrame:
    """Q5a as states that merge: per ``by``, ``n_<m>``, ``mean_<m>`` and ``m2_<m>``
    (sum of squared deviations from the mean) of each metric. NaN counts as NULL."""
    aggs = []
    for m in metrics:
        v = nan_to_null(m)
        aggs += [
            F.count(v).alias(f"n_{m}"),
            F.avg(v).alias(f"mean_{m}"),
            (F.var_pop(v) * F.count(v)).alias(f"m2_{m}"),
        ]
    return df.groupBy(*by).agg(*aggs)


def merge_moments(
    states: DataFrame, by: Sequence[str], metrics: Sequence[str], others: Sequence[Column] = ()
) -> DataFrame:
    """States merged per ``by``; the result is a state again, so days merge to
    months and months to years. Each group's squared deviations are taken from the
    group's own mean (Chan's rule for any number of parts), never as a difference
    of large sums, so that a small spread around a large mean keeps its digits."""
    by = list(by)
    means = states.groupBy(*by).agg(
        *[F.sum(F.col(f"n_{m}") * F.col(f"mean_{m}")).alias(f"_odx_s_{m}") for m in metrics],
        *[F.sum(f"n_{m}").alias(f"_odx_n_{m}") for m in metrics],
    ).select(
        *[F.col(k).alias(f"_odx_k_{k}") for k in by],
        *[F.try_divide(f"_odx_s_{m}", f"_odx_n_{m}").alias(f"_odx_mean_{m}") for m in metrics],
    )
    on = [states[k].eqNullSafe(means[f"_odx_k_{k}"]) for k in by]
    parts = states.join(means, on) if by else states.crossJoin(means)  # one row
    aggs = []
    for m in metrics:
        n, off = F.col(f"n_{m}"), F.col(f"mean_{m}") - F.col(f"_odx_mean_{m}")
        aggs += [
            F.sum(n).alias(f"n_{m}"),
            F.max(f"_odx_mean_{m}").alias(f"mean_{m}"),
            F.sum(F.col(f"m2_{m}") + n * off * off).alias(f"m2_{m}"),
        ]
    return parts.groupBy(*by).agg(*aggs, *others)


def profile_of(states: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """``by, mean_<m>, std_<m>``: the deviation profile that the states hold (one
    state per ``by``). A single reading has no deviation (NULL)."""
    return states.select(
        *by,
        *[
            c
            for m in metrics
            for c in (
                F.col(f"mean_{m}"),
                F.when(F.col(f"n_{m}") > 1, F.sqrt(F.col(f"m2_{m}") / (F.col(f"n_{m}") - 1))).alias(f"std_{m}"),
            )
        ],
    )
