"""Sharding by best-fit-decreasing bin packing.

Rows with equal texts form an indivisible group. Groups, largest first, enter
the shard with the tightest remaining capacity that still holds them; shards are
kept in a balanced order (a sorted list searched by bisection). The capacity is
an equal share of all bytes, so the law is ``bytes``: sizes near equal.

Packing is sequential, so it runs in two steps that both stay bounded. Groups of
at least ``1 / (shards * LARGE_PER_SHARD)`` of all bytes number at most ``shards
* LARGE_PER_SHARD`` and are packed first, by one task. All others are dealt by
hash into parts of about ``GROUPS_PER_PART`` groups; each part packs its own
groups into its proportional share of every shard's remaining capacity. A group
that no shard can hold whole in this sense enters the shard with the most room.

A group larger than one shard's capacity cannot be kept whole under the law; it
is split by row into pieces of about an eighth of the capacity. There are at
most ``shards`` such groups.

Defined results: a null text counts as empty and equals other empty texts; a
row's size is its UTF-8 bytes plus 16; repeated rows are separate rows of one
group; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.llm.common import block_offsets, materialize, read_table, ship_package

SHARDS = 40
LARGE_PER_SHARD = 64
GROUPS_PER_PART = 50_000
PIECES_PER_SHARD = 8  # of a group that must be split
ROW_OVERHEAD = 16
ROWS_PER_BLOCK = 8192


def best_fit_decreasing(sizes, room: list[float]) -> list[int]:
    """The bin of each item. Items by size, largest first (ties: as given);
    each enters the fullest bin that can hold it, else the emptiest bin.
    ``room`` (remaining capacity by bin) is updated."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    tree = sorted((r, b) for b, r in enumerate(room))
    out = [0] * len(sizes)
    for i in order:
        at = bisect_left(tree, (sizes[i], -1))
        r, b = tree.pop(at if at < len(tree) else -1)
        insort(tree, (r - sizes[i], b))
        out[i] = b
    for r, b in tree:
        room[b] = r
    return out


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = SHARDS
) -> DataFrame:
    """(row, id, size, text_crc32, shard, slot): every row's shard and its
    place there, gapless from 0."""
    ship_package(docs.sparkSession)
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.sha2(text, 256).alias("digest"),
        ),
        "shard-rows",
    )
    total, n_rows = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not n_rows:
        return rows.select("row", "id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    capacity = total / shards

    # The only groups that must be split: at most ``shards``, so a bounded list.
    sums = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    oversize = {r.digest: r.bytes for r in sums.filter(F.col("bytes") > capacity).collect()}
    piece = F.lit(0)
    for digest, size in oversize.items():
        n = -(-size * PIECES_PER_SHARD // int(capacity or 1))
        piece = F.when(F.col("digest") == digest, F.pmod(F.xxhash64("id", "row"), F.lit(int(n))).cast("int")).otherwise(
            piece
        )
    rows = rows.withColumn("piece", piece)
    groups = materialize(rows.groupBy("digest", "piece").agg(F.sum("size").alias("bytes")), "shard-groups")

    large_from = capacity / LARGE_PER_SHARD
    large = groups.filter(F.col("bytes") >= large_from).toPandas()  # at most shards * LARGE_PER_SHARD rows
    large = large.sort_values(["bytes", "digest", "piece"], ascending=[False, True, True], ignore_index=True)
    room = [capacity] * shards
    large["shard"] = best_fit_decreasing(large["bytes"].tolist(), room)
    placed = rows.sparkSession.createDataFrame(
        list(large[["digest", "piece", "shard"]].itertuples(index=False, name=None)),
        "digest string, piece int, shard int",
    )

    small = groups.filter(F.col("bytes") < large_from)
    n_small = small.count()
    parts = max(1, -(-n_small // GROUPS_PER_PART))
    left = [max(0.0, r) for r in room]
    whole = sum(left) or 1.0
    share = [r / whole for r in left]
    seeded = small.withColumn("part", F.pmod(F.xxhash64("digest", "piece"), F.lit(parts)).cast("int"))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["bytes", "digest", "piece"], ascending=[False, True, True])
        own = [s * float(part["bytes"].sum()) for s in share]
        return pd.DataFrame(
            {
                "digest": part["digest"],
                "piece": part["piece"].astype("int32"),
                "shard": pd.Series(best_fit_decreasing(part["bytes"].tolist(), own), index=part.index, dtype="int32"),
            }
        )

    packed = seeded.groupBy("part").applyInPandas(pack, "digest string, piece int, shard int")
    dealt = rows.join(placed.unionByName(packed), ["digest", "piece"])
    # Places inside a shard: counted in blocks, so no shard is one task's work.
    blocks = max(1, -(-n_rows // (ROWS_PER_BLOCK // 2)))
    dealt = dealt.withColumn("stretch", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    out = block_offsets(dealt, ["shard"], "stretch", [F.col("row")], F.lit(1).cast("long"), "slot")
    return out.select("row", "id", "size", "text_crc32", "shard", "slot")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
