"""SimHash near-deduplication with Golay-code fuzzy hashing.

A text's fingerprint has bit b set where more than half of the XXH64 hashes of
its word shingles have it set. Different fingerprints are linked when at most
two of their 64 bits differ; linked fingerprints form components.

Links are found by join, not by comparing all pairs. The fingerprint is cut into
segments A, B, C of 22, 21 and 21 bits. With two errors at most, by the
pigeonhole principle, some segment X has none and the next one Y (A-B, B-C or
C-A) has at most one. So each fingerprint gets keys (X, codeword index of Y):
three to look up with, from the codeword nearest to Y, and about sixteen to be
found by, from all codewords within four bits of Y. If Y and Y' differ in one
bit at most, the codeword nearest to Y is within 3 bits of Y and 4 of Y'; so
every link shares a key. Candidates are verified on all 64 bits.

A bucket found by more than ``MAX_BUCKET`` fingerprints would emit too many
pairs. Its members are linked another exact way: two fingerprints differ in at
most two bits just when some value is within one bit of both, so each member
emits its 65 neighbours, and the members that share one (65 at most) are linked
to the smallest of them. That is linear in the members, and gives the same
components.

Defined results: a null text counts as empty; a text without words has
fingerprint 0, linked like any other; fewer words than a shingle make one
shingle; repeated rows are separate rows of one fingerprint; null ids take no
part in the smallest id (all null: null); an empty table gives no rows; columns
other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odometrix.llm import golay
from odometrix.llm.common import ROW, materialize, numbered, read_table, ship_package

SHINGLE = 3
MAX_BITS = 2
SEED = 42
MAX_BUCKET = 256
CHUNK = 1 << 15  # hashes whose bits are counted at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((digest(g, SEED) for g in grams), dtype="<u8", count=n)
    ones = np.zeros(64, "int64")
    for at in range(0, n, CHUNK):
        part = hashes[at : at + CHUNK].view("u1").reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype="int64")
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, carry: Sequence[str] = ()
) -> DataFrame:
    """(row, id, fp) and the columns ``carry``: written once. fp is the
    fingerprint as a signed long."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            fps = np.array([fingerprint(t.as_py(), shingle) for t in texts], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps, pa.int64())], names=names)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), *carry, F.col(text_col)
    )
    names = ["row", "id", *carry, "fp"]
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("fp", T.LongType())])
    return materialize(rows.mapInArrow(run, schema), "simhash-rows")


_SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (shift, bits)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, fp, seek): the keys of each fingerprint; seek: to look up with."""
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).astype("i8")
        unsigned = fp.view("u8")
        part = [((unsigned >> np.uint64(s)) & np.uint64((1 << b) - 1)).astype("i8") for s, b in _SEGMENTS]
        keys, owner, seek = [], [], []
        for p in range(3):
            exact, fuzzy = part[p], part[(p + 1) % 3]
            head = (np.int64(p) << 34) | (exact << 12)
            keys += [head | golay.nearest(fuzzy)]
            owner += [fp]
            which, index = golay.within4(fuzzy)
            keys += [head[which] | index]
            owner += [fp[which]]
            seek += [np.ones(len(fp), bool), np.zeros(len(which), bool)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x)) for x in (keys, owner, seek)], names=["key", "fp", "seek"]
        )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(near, fp): each fingerprint with itself and its 64 one-bit neighbours."""
    flips = np.concatenate([np.zeros(1, "u8"), np.uint64(1) << np.arange(64, dtype="u8")])
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).astype("i8")
        near = (fp.view("u8")[:, None] ^ flips[None, :]).view("i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array(near.ravel()), pa.array(np.repeat(fp, 65))], names=["near", "fp"]
        )


def links(nodes: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(a, b) edges whose components are those of all links between the distinct
    fingerprints ``nodes.fp``. Outside crowded buckets these are the links
    themselves."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the key scheme covers at most two differing bits")
    ship_package(nodes.sparkSession)
    keys = materialize(nodes.select("fp").mapInArrow(_keys, "key long, fp long, seek boolean"), "simhash-keys")
    found = keys.filter("not seek").select("key", "fp")
    seek = keys.filter("seek").select("key", F.col("fp").alias("a"))
    crowded = materialize(
        found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_bucket).select("key"),
        "simhash-crowded",
    )
    some = not crowded.isEmpty()
    if some:
        calm_found, calm_seek = found.join(crowded, "key", "left_anti"), seek.join(crowded, "key", "left_anti")
    else:
        calm_found, calm_seek = found, seek
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    out = (
        calm_seek.join(calm_found.withColumnRenamed("fp", "b"), "key")
        .filter((F.col("a") < F.col("b")) & (differ <= max_bits))
        .select("a", "b")
    )
    if some:
        # Members of crowded buckets, on either side.
        members = (
            keys.join(crowded, "key", "left_semi").select("fp").distinct()
        )
        if max_bits == 2:
            shared = members.mapInArrow(_neighbours, "near long, fp long")
        else:  # within one bit: a member and the values one bit off that are members themselves
            shared = members.mapInArrow(_neighbours, "near long, fp long").join(
                members.select(F.col("fp").alias("near")), "near", "left_semi"
            )
            if max_bits == 0:
                shared = shared.filter("near = fp")
        # At most 65 members share a neighbour, so the list is bounded.
        stars = shared.groupBy("near").agg(F.sort_array(F.collect_set("fp")).alias("m")).filter(F.size("m") > 1)
        if max_bits == 2:
            pairs = stars.select(F.col("m")[0].alias("a"), F.explode(F.slice("m", F.lit(2), F.size("m"))).alias("b"))
        else:
            pairs = stars.select(F.col("near").alias("x"), F.explode("m").alias("y")).select(
                F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
            )
        out = out.unionByName(pairs.filter("a < b"))
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each edge's component, by alternating
    large-star and small-star contraction. Every step is a table in the shared
    folder; a hub meets its neighbours as one minimum per task."""
    edges = materialize(edges.select("a", "b").filter("a <> b"), "cc-edges")

    def digest(e: DataFrame):
        return e.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))
        ).first()

    def star(sym: DataFrame) -> DataFrame:
        """Every (u, v) with the smallest of u and its neighbours v."""
        low = sym.groupBy("u").agg(F.min("v").alias("m"))
        return sym.join(low.select("u", F.least("u", "m").alias("m")), "u")

    last = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        # Large star: larger neighbours of u move to u's smallest neighbour.
        large = star(both).filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        down = large.filter("a <> b").distinct().select(F.col("b").alias("u"), F.col("a").alias("v"))
        # Small star: u and its smaller neighbours move to the smallest of them.
        small = star(down)
        edges = materialize(
            small.select(F.col("m").alias("a"), F.col("v").alias("b"))
            .unionByName(small.select(F.col("m").alias("a"), F.col("u").alias("b")))
            .filter("a <> b")
            .distinct(),
            "cc-edges",
        )
        now = digest(edges)
        if now == last:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).distinct()
        last = now


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    max_bucket: int = MAX_BUCKET,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(row, id, fp, component_id, stays) and the columns ``carry``: every row's fingerprint, the smallest
    id in its component, and whether it is the one row of the component that
    stays (the smallest id; among equal ids, one of them)."""
    rows = fingerprints(docs, id_col, text_col, shingle, carry)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    nodes = materialize(rows.groupBy("fp").agg(first.alias("first")), "simhash-nodes")
    roots = materialize(components(links(nodes, max_bits, max_bucket)), "simhash-roots")
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    heads = named.groupBy("root").agg(F.min("first").alias("head"))
    heads = named.select("fp", "root").join(heads, "root").select("fp", "head")
    return rows.join(heads, "fp").select(
        "row",
        "id",
        "fp",
        F.col("head.id").alias("component_id"),
        (F.col("row") == F.col("head.row")).alias("stays"),
        *carry,
    )


def near_distinct(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component (the smallest doc_id)."""
    rows = numbered(docs, "simhash-docs")
    found = simhash_components(rows.select("doc_id", "text", ROW), carry=[ROW], **options)
    return rows.join(found.filter("stays").select(ROW), ROW, "left_semi").select(*docs.columns)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
