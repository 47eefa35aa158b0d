"""Hot keys: the keys that hold more than one partition's fair share of rows.

Shared by the salted profile join and the hybrid running totals. The set
has at most ``partitions`` rows whatever the data size, so it may be
broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNT = "_odx_n"
SALTS = "_odx_salts"

# Salts per fair partition's worth of a hot key's rows: pieces of a quarter
# partition, so that hash collisions of (key, salt) pairs average out.
SALTS_PER_PARTITION = 4


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key (partial aggregation: a hot key is one row per task)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT))


def hot_keys(counts: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """Keys holding more than ``1/partitions`` of all rows, with a salt count of
    ``ceil(SALTS_PER_PARTITION * n * partitions / total)``. At most
    ``partitions`` rows, and at most ``(SALTS_PER_PARTITION + 1) * partitions``
    salts in all."""
    # One row beside every key, in the same plan: unlike a scalar subquery it
    # reads the shuffle of ``counts`` that is there already. The zero made from
    # the keys keeps the optimizer from pruning them, and so from counting anew.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1))
    total = F.broadcast(counts.agg(F.sum(F.col(COUNT) + zero).alias("_odx_total")))
    share, total_n = F.col(COUNT) * F.lit(partitions), F.col("_odx_total")
    return counts.crossJoin(total).filter(share > total_n).select(
        *keys, F.ceil(share * F.lit(SALTS_PER_PARTITION) / total_n).cast("int").alias(SALTS)
    )
