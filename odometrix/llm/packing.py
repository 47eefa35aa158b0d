"""Best-fit packing of token sequences by swap-based local search.

Documents become runs of subword ids closed by id 0; runs longer than a sequence
are cut into full pieces and a shorter last one. Full pieces are sequences of
their own. All others are dealt by hash into groups of about
``PIECES_PER_GROUP``; each group is packed best-fit decreasing, then a local
search works on all underfull bins: it moves one or two pieces, or exchanges one
or two for one, between two bins wherever that raises the sum of squared fills,
so that full bins get fuller and others run empty, until no such change is left.
Partners are found by bisection in an index of the sizes that bins offer.

A group holds lengths only (no texts) and its size is bounded, so memory is
bounded at any scale. The result is a local optimum of these changes.

Defined results: a null text counts as empty and gives one piece of one token
(id 0); repeated rows are packed as separate documents; an empty table gives no
rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.llm.common import materialize, read_table, ship_package
from odometrix.llm.subwords import tokenizer_path, word_encoder

CAPACITY = 2048
PIECES_PER_GROUP = 60_000

PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenize_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, capacity: int = CAPACITY,
    vocabulary: str | None = None,
) -> DataFrame:
    """Pieces of every document: row, doc_id, piece, start, length, ids_crc32."""
    ship_package(docs.sparkSession)
    path = vocabulary or tokenizer_path()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for row, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids = encoder.encode_text(text or "") + b"\0\0\0\0"
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(out, (row, doc, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
                names=["row", "doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)
    )
    return rows.mapInArrow(pieces, PIECES)


def best_fit(lengths, capacity: int) -> list[list[int]]:
    """Bins of item numbers, best-fit decreasing: the fullest bin with room."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins: list[list[int]] = []
    tree: list[tuple[int, int]] = []  # (room, bin), sorted
    for i in order:
        need = lengths[i]
        at = bisect_left(tree, (need, -1))
        if at < len(tree):
            room, b = tree.pop(at)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if room > need:
            insort(tree, (room - need, b))
    return bins


class _Offers:
    """For every size, the bins that can give it (in one piece or in two), by fill."""

    def __init__(self):
        self.sizes: list[int] = []  # those with bins, sorted
        self.bins: dict[int, list[tuple[int, int]]] = {}  # size: (fill, bin), sorted

    def add(self, size: int, entry: tuple[int, int]) -> None:
        held = self.bins.get(size)
        if held:
            insort(held, entry)
        else:
            self.bins[size] = [entry]
            insort(self.sizes, size)

    def remove(self, size: int, entry: tuple[int, int]) -> None:
        held = self.bins[size]
        del held[bisect_left(held, entry)]
        if not held:
            del self.bins[size]
            del self.sizes[bisect_left(self.sizes, size)]


def _sums_of_two(sizes: dict[int, list[int]]) -> set[int]:
    """What two items of a bin take. A bin has few different sizes, however many
    items: their sum is at most its capacity."""
    each = list(sizes)
    sums = {x + y for k, x in enumerate(each) for y in each[:k]}
    return sums | {2 * x for x, items in sizes.items() if len(items) > 1}


def local_search(bins: list[list[int]], lengths, capacity: int) -> list[list[int]]:
    """Raise the squared fill of underfull bins by moves and exchanges until a
    whole pass over them changes nothing, or no fewer bins could hold the items;
    emptied bins go."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    total, used = sum(fill), sum(f > 0 for f in fill)
    lower = -(-total // capacity)
    held: dict[int, dict[int, list[int]]] = {}  # underfull bin: size: items
    ones, twos = _Offers(), _Offers()

    def enter(b: int) -> None:
        for size in held[b]:
            ones.add(size, (fill[b], b))
        for size in _sums_of_two(held[b]):
            twos.add(size, (fill[b], b))

    def leave(b: int) -> None:
        for size in held[b]:
            ones.remove(size, (fill[b], b))
        for size in _sums_of_two(held[b]):
            twos.remove(size, (fill[b], b))

    def best_change(p: int):
        """(what p gains, size leaving p or 0, size leaving q, in two items?, q):
        the largest gain, from the emptiest bin that offers it; or None."""
        best, most = None, 0
        for out in (0, *held[p]):
            for offers in (ones, twos):
                at = bisect_right(offers.sizes, out + capacity - fill[p]) - 1
                while at >= 0 and (delta := offers.sizes[at] - out) > most:
                    entries = offers.bins[offers.sizes[at]]
                    if entries[0][1] != p:
                        f, q = entries[0]
                    elif len(entries) > 1:
                        f, q = entries[1]
                    else:
                        f, q = capacity * 2, -1
                    # The squared fills rise by 2 * delta * (fill[p] - f + delta).
                    if f < fill[p] + delta:
                        best, most = (delta, out, offers.sizes[at], offers is twos, q), delta
                        break
                    at -= 1
        return best

    def take(b: int, size: int) -> int:
        items = held[b][size]
        i = items.pop()
        if not items:
            del held[b][size]
        return i

    def give(b: int, i: int) -> None:
        held[b].setdefault(lengths[i], []).append(i)

    for b, items in enumerate(bins):
        if 0 < fill[b] < capacity:
            held[b] = {}
            for i in items:
                give(b, i)
            enter(b)
    changed = True
    while changed and used > lower:
        changed = False
        for p in sorted(held, key=lambda b: -fill[b]):
            while used > lower and 0 < fill[p] < capacity and (found := best_change(p)):
                delta, out, size, two, q = found
                leave(p)
                leave(q)
                if two:
                    x = next(x for x in held[q] if size - x in held[q] and (2 * x != size or len(held[q][x]) > 1))
                    coming = [take(q, x), take(q, size - x)]
                else:
                    coming = [take(q, size)]
                if out:
                    give(q, take(p, out))
                for i in coming:
                    give(p, i)
                fill[p] += delta
                fill[q] -= delta
                used -= not fill[q]
                for b in (p, q):
                    if 0 < fill[b] < capacity:
                        enter(b)
                changed = True
            if used <= lower:
                break
    for b, sizes in held.items():
        bins[b] = [i for items in sizes.values() for i in items]
    return [b for b in bins if b]


def pack_group(lengths, capacity: int) -> list[list[int]]:
    return local_search(best_fit(lengths, capacity), lengths, capacity)


def pack_pieces(pieces: DataFrame, *, capacity: int = CAPACITY, per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """``pieces`` (written table) with sequence_id and offset. Two pieces share
    a sequence only inside one group; ids are (group + 1) * 2^32 + bin, and for
    full pieces a negative number of their own."""
    ship_package(pieces.sparkSession)
    full = pieces.filter(F.col("length") >= capacity).select(
        "*",
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rest = pieces.filter(F.col("length") < capacity)
    groups = max(1, round(rest.count() / per_group))
    dealt = rest.withColumn("grp", F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(groups)).cast("int"))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        # Same order whatever way the rows came, so reruns agree.
        part = part.sort_values(["length", "doc_id", "row", "piece"], ignore_index=True)
        lengths = part["length"].tolist()
        sequence, offset = np.empty(len(lengths), "int64"), np.empty(len(lengths), "int64")
        base = (int(part["grp"].iloc[0]) + 1) << 32
        for b, items in enumerate(pack_group(lengths, capacity)):
            at = 0
            for i in items:
                sequence[i], offset[i] = base + b, at
                at += lengths[i]
        return part.drop(columns="grp").assign(sequence_id=sequence, offset=offset)

    packed = dealt.groupBy("grp").applyInPandas(pack, PIECES + ", sequence_id long, offset long")
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, capacity: int = CAPACITY) -> DataFrame:
    """Every document's pieces with the sequence and offset they are packed to."""
    pieces = materialize(tokenize_pieces(docs, id_col, text_col, capacity=capacity), "pack-pieces")
    return pack_pieces(pieces, capacity=capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
