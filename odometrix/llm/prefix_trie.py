"""Conversation prefix trie by a splitter skeleton.

A conversation is a path of turns; every distinct path prefix is a node. Equal
whole paths are first counted as one, so copies of a conversation cost one row.
The distinct paths are dealt to shards by splitter paths taken from a bounded
sample. The skeleton, that is the trie of the splitters, is broadcast: a node
whose paths lie in more than one shard is a prefix of a splitter, so all nodes
outside the skeleton are finished by a single pass over one sorted shard,
holding one open path. A first turn shared by a third of all conversations is a
skeleton node; for those each shard gives one partial (smallest member, members,
children, leaves and saved tokens that lie outside the skeleton), and the
partials are combined by reduction. The skeleton has at most ``shards *
SPLITTER_DEPTH`` nodes, whatever the data.

Turns are told apart by the SHA-256 of role and text; a conversation is held as
one row of such digests, 40 bytes a turn, while its texts are never shuffled.
The ids that end at a node are hashed in order from blocks that each task of a
range-partitioned sort has joined, so no task holds the ids of one node.

Defined results: turns of one conversation with equal ``turn`` are ordered by
role, then by digest; null turns come first; repeated rows are repeated turns;
null role or text is empty; rows without conv_id belong to no conversation and
are left out; an empty table has no nodes, not even a root; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.llm.common import materialize, read_table, ship_package

STRIDE = 100  # conversation c starts like conversation c - c % STRIDE
HEADS = 6  # by fewer than so many turns
SPLITTER_DEPTH = 64  # turns of a splitter; only balance hangs on it
SAMPLE_PER_SHARD = 20  # sampled paths a shard (on average), of at most SPLITTER_DEPTH turns
BLOCK_IDS = 1 << 15  # ids joined into one string


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, seq): each conversation's (digest, chars) in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            "turn",
            role.alias("role"),
            F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"),
            F.length(text).cast("long").alias("chars"),
        ).alias("t"),
    )
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("seq"))
    turn = F.transform("seq", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars")))
    return lists.select("conv_id", turn.alias("seq"))


def rebuilt_paths(turns: DataFrame, stride: int = STRIDE, heads: int = HEADS) -> DataFrame:
    """(conv_id, path, chars, key): conversations that begin with the first turns
    of their group's first one, written once. ``key`` names the whole path."""
    lists = materialize(turn_lists(turns), "trie-turns")
    first = lists.filter(F.col("conv_id") % stride == 0).select(
        F.col("conv_id").alias("first"), F.slice("seq", 1, max(heads - 1, 1)).alias("head")
    )
    n_head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    own = lists.withColumns({"first": F.col("conv_id") - F.col("conv_id") % stride, "h": n_head})
    none = F.array().cast(lists.schema["seq"].dataType)
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    seq = F.concat(head, F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq"), F.lit(1))))
    rows = own.join(first, "first", "left").select("conv_id", seq.alias("seq"))
    rows = rows.select("conv_id", F.col("seq.digest").alias("path"), F.col("seq.chars").alias("chars"))
    return materialize(rows.withColumn("key", path_key(F.col("path"))), "trie-paths")


def path_key(path: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(F.transform(path, F.hex), "").cast("binary"), 256))


class Skeleton:
    """The splitters and their trie: ``child[(node, digest)]`` is a node's number;
    0 is the root."""

    def __init__(self, splitters: list[tuple[bytes, ...]]):
        self.splitters = splitters
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent = [-1]
        for path in splitters:
            node = 0
            for digest in path:
                at = self.child.setdefault((node, digest), len(self.parent))
                if at == len(self.parent):
                    self.parent.append(node)
                node = at

    def shard(self, path: list[bytes]) -> int:
        return bisect_right(self.splitters, tuple(path))


def choose_splitters(distinct: DataFrame, shards: int) -> Skeleton:
    """Splitters that cut a sample of at most about ``SAMPLE_PER_SHARD * shards``
    paths into shards of equal numbers of turns. The sample hangs on the paths'
    keys alone, so that reruns agree."""
    total = distinct.count()
    share = min(1.0, SAMPLE_PER_SHARD * shards / max(total, 1))
    hashed = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    rows = distinct.filter(hashed).select(
        F.slice("path", 1, SPLITTER_DEPTH).alias("path"), (F.size("path") + 1).alias("w")
    )
    sample = sorted((tuple(bytes(d) for d in r.path), r.w) for r in rows.collect())
    step = sum(w for _, w in sample) / shards
    splitters: list[tuple[bytes, ...]] = []
    passed = 0
    for path, w in sample:
        if passed >= step * (len(splitters) + 1) and path and (not splitters or path > splitters[-1]):
            splitters.append(path)
        passed += w
    return Skeleton(splitters)


NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, chars long, end_key binary, skeleton int, parent_skeleton int"
)
_FIELDS = [f.split()[0] for f in NODES.split(", ")]
_KINDS = {"long": pa.int64(), "binary": pa.binary(), "int": pa.int32()}
_ARROW = pa.schema([(f.split()[0], _KINDS[f.split()[1]]) for f in NODES.split(", ")])


class _Open:
    """A node of the open path."""

    __slots__ = ("digest", "chars", "skeleton", "low", "n", "children", "leaves", "saved", "end_key", "waiting")

    def __init__(self, digest: bytes, chars: int, skeleton: int | None):
        self.digest, self.chars, self.skeleton = digest, chars, skeleton
        self.low: int | None = None
        self.n = self.children = self.leaves = self.saved = 0
        self.end_key: bytes | None = None
        self.waiting: list[list] = []  # finished children, which want this node's smallest member


def shard_nodes(rows: Iterator[tuple], skeleton: Skeleton) -> Iterator[list]:
    """Nodes of one sorted shard: (path, chars, conv_id, n, key) rows in path
    order. Those of the skeleton come as partials."""
    open_path = [_Open(b"", 0, 0)]
    for path, chars, conv_id, n, key in rows:
        common = 0
        while common < len(path) and common + 1 < len(open_path) and open_path[common + 1].digest == path[common]:
            common += 1
        while len(open_path) > common + 1:
            yield from _close(open_path)
        for d in range(common, len(path)):
            up = open_path[-1].skeleton
            open_path.append(_Open(path[d], chars[d], None if up is None else skeleton.child.get((up, path[d]))))
        top = open_path[-1]
        top.end_key, top.n, top.low = key, top.n + n, conv_id if top.low is None else min(top.low, conv_id)
    while open_path:
        yield from _close(open_path)


def _close(open_path: list[_Open]) -> Iterator[list]:
    node, depth = open_path.pop(), len(open_path)
    up = open_path[-1] if open_path else None
    if node.n == 0:
        return
    for row in node.waiting:
        row[2] = node.low
        yield row
    inside = node.skeleton is None
    if inside:
        node.leaves += node.children == 0
        node.saved += (node.n - 1) * node.chars
    row = [node.low, depth, None, node.n, node.children, node.leaves, node.saved, node.chars, node.end_key,
           node.skeleton, None]
    if up is not None:
        up.n, up.low = up.n + node.n, node.low if up.low is None else min(up.low, node.low)
        up.leaves, up.saved = up.leaves + node.leaves, up.saved + node.saved
        up.children += inside
        if inside and up.skeleton is None:
            up.waiting.append(row)
            return
        row[10] = up.skeleton
    yield row


def _batches(rows: Iterator[list], size: int = 4096) -> Iterator[pa.RecordBatch]:
    block: list[list] = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), _ARROW)], schema=_ARROW)
            block = []
    if block:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), _ARROW)], schema=_ARROW)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
    for batch in batches:
        shard, *rest = (batch.column(i).to_pylist() for i in range(batch.num_columns))
        yield from zip(shard, zip(*rest))


def trie_partials(distinct: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Finished nodes, and the skeleton's partials, of all shards: written once."""
    spark = distinct.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(skeleton)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bones = shared.value
        for batch in batches:
            shard = pa.array([bones.shard(p) for p in batch.column("path").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, *batch.columns], names=["shard", *batch.schema.names])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        for _, rows in groupby(_by_shard(batches), lambda r: r[0]):
            yield from _batches(shard_nodes((r for _, r in rows), shared.value))

    fields = "shard int, path array<binary>, chars array<long>, conv_id long, n long, key binary"
    dealt = distinct.select("path", "chars", "conv_id", "n", "key").mapInArrow(deal, fields)
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", "path")
    return materialize(ordered.mapInArrow(scan, NODES), "trie-nodes")


def finish_skeleton(partials: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The skeleton's nodes, from their partials. One row per skeleton node comes
    to the driver, a number that the parameters bound."""
    reduced = (
        partials.filter("skeleton is not null")
        .groupBy("skeleton")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.max("chars").alias("chars"),
            F.max("end_key").alias("end_key"),
        )
    )
    nodes = {r.skeleton: r.asDict() for r in reduced.collect()}
    # A child's number is larger than its parent's: children before parents.
    own = {}
    for k in nodes:
        if (up := skeleton.parent[k]) >= 0:
            nodes[up]["n_children"] += 1
    for k, node in nodes.items():
        own[k] = [int(node["n_children"] == 0), (node["n_convs"] - 1) * node["chars"]]
    for k in sorted(nodes, reverse=True):
        if (up := skeleton.parent[k]) >= 0:
            own[up][0] += own[k][0]
            own[up][1] += own[k][1]
    rows = [
        (
            n["conv_id"], n["depth"], nodes[skeleton.parent[k]]["conv_id"] if skeleton.parent[k] >= 0 else None,
            n["n_convs"], n["n_children"], n["n_leaves"] + own[k][0], n["saved_tokens"] + own[k][1], n["chars"],
            n["end_key"], k, None,
        )
        for k, n in nodes.items()
    ]
    return partials.sparkSession.createDataFrame(rows, NODES)


def end_hashes(paths: DataFrame) -> DataFrame:
    """(end_key, ends_sha256): SHA-256 of the ascending ids of each whole path."""

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for batch in batches:
            out = []
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (k != key or len(ids) == BLOCK_IDS):
                    out.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(c)
            yield _ids(out, part)
        yield _ids([(key, ids[0], ",".join(map(str, ids)))] if ids else [], part)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if state:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(("," + text).encode())
            yield _ids(out, whole)
        yield _ids([(key, state.hexdigest())] if state else [], whole)

    part = pa.schema([("end_key", pa.binary()), ("low", pa.int64()), ("ids", pa.string())])
    whole = pa.schema([("end_key", pa.binary()), ("ends_sha256", pa.string())])
    ordered = paths.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    blocks = ordered.mapInArrow(join_ids, "end_key binary, low long, ids string")
    blocks = blocks.repartition("end_key").sortWithinPartitions("end_key", "low")
    return blocks.mapInArrow(digest, "end_key binary, ends_sha256 string")


def _ids(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def conversation_trie(
    turns: DataFrame, *, stride: int = STRIDE, heads: int = HEADS, shards: int | None = None
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    spark = turns.sparkSession
    paths = rebuilt_paths(turns, stride, heads)
    distinct = materialize(
        paths.groupBy("key").agg(
            F.first("path").alias("path"),
            F.first("chars").alias("chars"),
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n"),
        ),
        "trie-distinct",
    )
    skeleton = choose_splitters(distinct, shards or int(spark.conf.get("spark.sql.shuffle.partitions")))
    partials = trie_partials(distinct, skeleton)
    bones = finish_skeleton(partials, skeleton)
    ups = F.broadcast(bones.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("up")))
    local = (
        partials.filter("skeleton is null")
        .join(ups, "parent_skeleton", "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up"))
        .select(*_FIELDS)
    )
    nodes = local.unionByName(bones)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    # Apart: the many nodes at which nothing ends would meet on one null key.
    ended = nodes.filter("end_key is not null").join(end_hashes(paths), "end_key")
    rest = nodes.filter("end_key is null").withColumn("ends_sha256", nothing)
    return ended.unionByName(rest).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read_table(spark, sf_dir, "conversations"))


OP12_SQL = f"""
WITH RECURSIVE step(i, k, v) AS (
  SELECT i, 0, i FROM range(256) AS r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY i) AS tab FROM step WHERE k = 8
), own AS (
  SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST,
         coalesce(role, ''), sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS seq
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT c, seq, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                                 lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % {HEADS} AS h
  FROM own, crc
), full_path AS (
  SELECT h.c, list_concat(list_slice(coalesce(o.seq, []), 1, h.h), list_slice(h.seq, h.h + 1, len(h.seq))) AS p
  FROM h LEFT JOIN own o ON o.c = h.c - h.c % {STRIDE}
), pre AS (
  SELECT c, d, p[1:d] AS node, d = len(p) AS at_end FROM (SELECT c, p, unnest(range(0, len(p) + 1)) AS d FROM full_path)
), g AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n, coalesce(length(node[d].t), 0) AS chars,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (at_end), '')) AS ends_sha256
  FROM pre GROUP BY node, d
), kids AS (
  SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n_children FROM g WHERE d > 0 GROUP BY ALL
), gk AS (
  SELECT g.*, coalesce(k.n_children, 0) AS n_children FROM g LEFT JOIN kids k ON k.d = g.d AND k.node = g.node
), sub AS (
  SELECT node[1:a] AS node, a AS d, count(*) FILTER (n_children = 0) AS n_leaves,
         sum((n - 1) * chars) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM gk) GROUP BY ALL
)
SELECT gk.conv_id, gk.d AS depth, up.conv_id AS parent_conv_id, gk.n AS n_convs, gk.n_children,
       sub.n_leaves, sub.saved::BIGINT AS saved_tokens, gk.ends_sha256
FROM gk JOIN sub ON sub.d = gk.d AND sub.node = gk.node
LEFT JOIN g up ON up.d = gk.d - 1 AND up.node = gk.node[1:gk.d - 1]
"""
