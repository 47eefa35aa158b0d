"""Suffix-array deduplication of repeated substrings.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (smaller
id, or earlier in the same text) is removed. Sorting all suffixes of a corpus
moves every position through a shuffle; here only the positions that can tell
strings apart are moved, and the result stays exact:

1. *Anchors.* In every window of LENGTH bytes the ``GRAM``-byte gram with the
   smallest hash is its anchor. Equal windows have equal anchors at equal
   offsets. The windows that share one anchor form a region; about one position
   in forty is an anchor. Regions with equal anchor, extent and bytes are told
   by hash: all but the earliest are removed whole. Equal regions of one chunk
   are combined before the shuffle, so a group of copies of any size reaches it
   as one row per chunk.
2. *Suffix order.* Where one anchor gram stands in different regions, the text
   from each anchor forwards and from each anchor backwards is sorted by
   deep-shallow sorting. Common prefixes of neighbours cut both orders into
   classes at every depth; the window at offset d is known by its forward class
   at depth LENGTH - d and its backward class at depth d, and is removed unless
   it is the earliest of its class pair.
3. *Apply.* The removed stretches of a document are merged and cut out.

A gram that stands in more than ``MAX_REGIONS`` different regions is not
gathered in one task: its windows are compared as rows, by an aggregate on their
bytes that finds the earliest and a join back.

Defined results: a null text counts as empty; texts shorter than LENGTH lose
nothing; a null id comes before all others; rows with equal ids are separate
documents, in the order of their names (file and place); an empty table gives no rows; columns other than id
and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odometrix.llm.common import ROW, materialize, numbered, read_table, ship_package
from odometrix.llm.deep_shallow import deep_shallow_order, neighbour_prefixes

LENGTH = 100
GRAM = 24
CHUNK = 1 << 21  # bytes whose windows are hashed at once
MAX_REGIONS = 50_000
REGIONS_PER_TASK = 20_000
NAME = ["file", "row"]  # columns that name a row of the input

_POS_BITS = 24
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S32 = np.uint64(32)
_LEAST = -(1 << 63)


def _join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = left * _C1 + right * _C2
    h ^= h >> _S32
    return h


def _levels(data: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of the 8, 16, 32 and 64 bytes from every position (padded)."""
    padded = np.concatenate([data, np.zeros(2 * LENGTH, "u1")])
    h = (padded.astype("u8") + np.uint64(1)) * _C2
    out, size = {}, 1
    while size < 64:
        h = _join_hashes(h[: len(h) - size], h[size:])
        size *= 2
        if size >= 8:
            out[size] = h
    return out


def find_anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Regions of the texts laid end to end in ``data`` (``ends``: where each
    ends): (gram hash, region hash, anchor, first window, last window), all
    positions in ``data``. Windows never cross a text's end."""
    n = len(data)
    none = np.zeros(0, "i8")
    if n < LENGTH:
        return none.view("u8"), none.view("u8"), none, none, none
    level = _levels(data)
    count = n - LENGTH + 1
    span = LENGTH - GRAM + 1  # grams of a window
    grams = n - GRAM + 1
    gram = _join_hashes(level[16][:grams], level[8][16 : grams + 16])
    key = ((gram * _C1) >> np.uint64(_POS_BITS) << np.uint64(_POS_BITS)) | np.arange(grams, dtype="u8")
    size = 1
    while 2 * size <= span:
        key = np.minimum(key[: len(key) - size], key[size:])
        size *= 2
    rest = span - size
    key = np.minimum(key[: len(key) - rest], key[rest:]) if rest else key
    anchor = (key[:count] & np.uint64((1 << _POS_BITS) - 1)).astype("i8")
    del key
    start = np.arange(count)
    valid = np.zeros(count, bool)
    begin = 0
    for end in ends.tolist():
        if end - begin >= LENGTH:
            valid[begin : end - LENGTH + 1] = True
        begin = end
    start, anchor = start[valid], anchor[valid]
    if not len(start):
        return none.view("u8"), none.view("u8"), none, none, none
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.nonzero(new)[0]
    first = start[at]
    last = start[np.append(at[1:], len(start)) - 1]
    anchor = anchor[at]
    # Three 64-byte hashes cover a region of at most 192 bytes.
    extent = last - first + LENGTH
    h64 = level[64]
    region = _join_hashes(h64[first], h64[first + (extent - 64) // 2])
    region = _join_hashes(region, h64[first + extent - 64])
    region = _join_hashes(region, ((anchor - first) << 8 | (last - first)).astype("u8"))
    return gram[anchor], region, anchor, first, last


def _pieces(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int, int, int, bytes]]]:
    """Chunks of (id, file, row, offset, bytes); a long text is cut into pieces that
    overlap by LENGTH - 1, so every window lies in exactly one."""
    chunk, size = [], 0
    ids = batch.column(0).to_pylist()
    files, rows = batch.column(1).to_pylist(), batch.column(2).to_pylist()
    for k, text in enumerate(batch.column(3)):
        raw = (text.as_py() or "").encode("utf-8", "replace")
        for at in range(0, max(1, len(raw) - LENGTH + 1), CHUNK):
            part = raw[at : at + CHUNK + LENGTH - 1]
            if size + len(part) > CHUNK + LENGTH and chunk:
                yield chunk
                chunk, size = [], 0
            chunk.append((_LEAST if ids[k] is None else ids[k], files[k], rows[k], at, part))
            size += len(part)
    if chunk:
        yield chunk


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, region, id, file, row, place, whole): the regions of every text; place
    packs first window, anchor offset and windows. Of equal regions in a chunk
    only the earliest goes on; the others are ``whole``: removed."""
    for batch in batches:
        for chunk in _pieces(batch):
            lengths = np.array([len(c[4]) for c in chunk], "i8")
            ends = np.cumsum(lengths)
            gram, region, anchor, first, last = find_anchors(np.frombuffer(b"".join(c[4] for c in chunk), "u1"), ends)
            if not len(gram):
                continue
            owner = np.searchsorted(ends, first, side="right")
            ids, files, rows, offset = (np.array([c[k] for c in chunk], "i8")[owner] for k in range(4))
            shift = offset - (ends - lengths)[owner]
            place = ((first + shift) << 16) | ((anchor - first) << 8) | (last - first)
            order = np.lexsort((place, rows, files, ids, region, gram))
            gram, region, ids, files, rows, place = (x[order] for x in (gram, region, ids, files, rows, place))
            again = np.zeros(len(gram), bool)
            again[1:] = (gram[1:] == gram[:-1]) & (region[1:] == region[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (gram.view("i8"), region.view("i8"), ids, files, rows, place, again)],
                names=["gram", "region", "id", "file", "row", "place", "whole"],
            )


def _region_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each asked region: the bytes before the anchor, reversed, and from it on."""
    for batch in batches:
        out: list[list] = [[] for _ in range(7)]
        for id_, file, row, text, asked in zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True):
            raw = (text or "").encode("utf-8", "replace")
            for a in asked:
                first, offset, windows = a["place"] >> 16, a["place"] >> 8 & 255, a["place"] & 255
                anchor = first + offset
                back, forth = raw[first:anchor][::-1], raw[anchor : first + windows + LENGTH]
                for column, value in zip(out, (a["gram"], id_, file, row, a["place"], back, forth), strict=True):
                    column.append(value)
        kinds = (*[pa.int64()] * 5, pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
            names=["gram", "id", "file", "row", "place", "back", "forth"],
        )


def repeated_windows(back: list[bytes], forth: list[bytes], place: np.ndarray, age: np.ndarray) -> list[tuple[int, int, int]]:
    """(region number, first, last window) of windows that are not the earliest
    of their kind. ``age``: rank of each region by (id, file, row, place)."""
    n = len(place)
    offset, windows = place >> 8 & 255, place & 255
    classes = []
    for texts in (back, forth):
        order = deep_shallow_order(texts)
        classes.append((np.array(order), neighbour_prefixes(texts, order)))
    hit: list[np.ndarray] = []
    which: list[np.ndarray] = []
    for d in range(LENGTH - GRAM + 1):  # window start = anchor - d
        chosen = np.nonzero((offset >= d) & (offset - d <= windows))[0]
        if len(chosen) < 2:
            continue
        number = []
        for (order, prefix), depth in zip(classes, (d, LENGTH - d), strict=True):
            known = np.empty(n, "i8")
            known[order] = np.cumsum(prefix < depth) if depth else 0
            number.append(known[chosen])
        by = np.lexsort((age[chosen], number[1], number[0]))
        b, f = number[0][by], number[1][by]
        again = np.zeros(len(by), bool)
        again[1:] = (b[1:] == b[:-1]) & (f[1:] == f[:-1])
        found = chosen[by[again]]
        which.append(found)
        hit.append((place[found] >> 16) + offset[found] - d)
    if not hit:
        return []
    region, start = np.concatenate(which), np.concatenate(hit)
    by = np.lexsort((start, region))
    region, start = region[by], start[by]
    new = np.ones(len(region), bool)
    new[1:] = (region[1:] != region[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.nonzero(new)[0]
    last = start[np.append(at[1:], len(start)) - 1]
    return list(zip(region[at].tolist(), start[at].tolist(), last.tolist(), strict=True))


def _sort_task(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values(["id", "file", "row", "place"], ignore_index=True)
    found = repeated_windows(
        part["back"].tolist(), part["forth"].tolist(), part["place"].to_numpy("i8"), np.arange(len(part))
    )
    at = [r for r, _, _ in found]
    return pd.DataFrame(
        {
            "file": pd.Series(part["file"].to_numpy("i8")[at], dtype="int64"),
            "row": pd.Series(part["row"].to_numpy("i8")[at], dtype="int64"),
            "start": pd.Series([s for _, s, _ in found], dtype="int64"),
            "end": pd.Series([e + LENGTH for _, _, e in found], dtype="int64"),
        }
    )


def _windows_of_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bytes, id, file, row, start) of every window of the given regions."""
    for batch in batches:
        out: list[list] = [[] for _ in range(5)]
        for _, id_, file, row, place, b, f in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            raw = b[::-1] + f
            for k in range((place & 255) + 1):
                for column, value in zip(out, (raw[k : k + LENGTH], id_, file, row, (place >> 16) + k), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(out, (pa.binary(), *[pa.int64()] * 4), strict=True)],
            names=["bytes", "id", "file", "row", "start"],
        )


def removed_spans(docs: DataFrame, *, max_regions: int = MAX_REGIONS) -> DataFrame:
    """(file, row, start, end) byte stretches to remove, overlapping. ``docs``: id, text
    and the row's name, file and row."""
    spark = docs.sparkSession
    ship_package(spark)
    anchors = docs.select("id", *NAME, "text").mapInArrow(
        _anchor_rows, "gram long, region long, id long, file long, row long, place long, whole boolean"
    )
    # Rows already told apart in their chunk only pass through: dealt by row.
    deal = F.when(F.col("whole"), F.xxhash64(*NAME, "place")).otherwise(F.col("gram"))
    group = Window.partitionBy("deal", "whole")
    earlier = F.lag("region").over(group.orderBy("region", "id", *NAME, "place"))
    marked = (
        anchors.withColumn("deal", deal)
        .withColumn("dup", F.col("whole") | earlier.eqNullSafe(F.col("region")))
        .withColumn("mixed", F.min("region").over(group) != F.max("region").over(group))
        .filter("dup or (mixed and not whole)")
        .select("gram", "id", *NAME, "place", "dup")
    )
    marked = materialize(marked, "substring-regions")
    start = F.shiftright("place", 16)
    whole = marked.filter("dup").select(
        *NAME, start.alias("start"), (start + F.col("place").bitwiseAND(255) + LENGTH).alias("end")
    )

    mixed = marked.filter("not dup")
    asked = mixed.groupBy(*NAME).agg(F.collect_list(F.struct("gram", "place")).alias("asked"))
    texts = materialize(
        docs.withColumn("id", F.coalesce("id", F.lit(_LEAST)))
        .join(asked, NAME)
        .select("id", *NAME, "text", "asked")
        .mapInArrow(
            _region_texts, "gram long, id long, file long, row long, place long, back binary, forth binary"
        ),
        "substring-texts",
    )
    sizes = texts.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    crowded = materialize(sizes.filter(F.col("n") > max_regions).select("gram"), "substring-crowded")
    spans = whole
    calm = texts
    if not crowded.isEmpty():
        calm = texts.join(crowded, "gram", "left_anti")
        rows = texts.join(crowded, "gram", "left_semi").mapInArrow(
            _windows_of_regions, "bytes binary, id long, file long, row long, start long"
        )
        rows = materialize(rows, "substring-windows")
        place = F.struct("id", *NAME, "start")
        first = rows.groupBy("bytes").agg(F.min(place).alias("first"))
        spans = spans.unionByName(
            rows.join(first, "bytes")
            .filter(place != F.col("first"))
            .select(*NAME, "start", (F.col("start") + LENGTH).alias("end"))
        )
    tasks = max(1, -(-texts.count() // REGIONS_PER_TASK))
    sorted_out = (
        calm.withColumn("task", F.pmod(F.xxhash64("gram"), F.lit(tasks)).cast("int"))
        .groupBy("task")
        .applyInPandas(lambda part: _sort_task(part), "file long, row long, start long, end long")
    )
    return spans.unionByName(sorted_out)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching stretches."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[] for _ in range(5)]
        for id_, text, spans in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
            raw = (text or "").encode("utf-8", "replace")
            runs = merge_spans([(s["start"], s["end"]) for s in spans or ()])
            at, kept = 0, []
            for s, e in runs:
                kept.append(raw[at:s])
                at = e
            kept.append(raw[at:])
            rest = b"".join(kept)
            for column, value in zip(out, (id_, len(raw), runs, rest, len(raw) - len(rest)), strict=True):
                column.append(value)
        runs_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(out[0], pa.int64()),
                pa.array(out[1], pa.int64()),
                pa.array([[{"start": s, "end": e} for s, e in r] for r in out[2]], runs_type),
                pa.array(out[3], pa.binary()),
                pa.array(out[4], pa.int64()),
            ],
            names=["id", "n_bytes", "removed", "kept", "n_removed"],
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n_bytes, removed, kept, n_removed) of every document: the maximal
    removed runs and the remaining bytes."""
    # Read three times below, so every row needs a name that stays.
    rows = numbered(docs, "substring-rows").select(
        F.col(id_col).cast("long").alias("id"),
        F.col(f"{ROW}.file").alias("file"),
        F.col(f"{ROW}.place").alias("row"),
        F.col(text_col).alias("text"),
    )
    spans = removed_spans(rows, **options).groupBy(*NAME).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return (
        rows.join(spans, NAME, "left")
        .select("id", "text", "spans")
        .mapInArrow(
            _apply,
            "id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary, n_removed long",
        )
    )


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
