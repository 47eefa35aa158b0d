"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents, in a hashed order, form one stream of words, repeated
as often as the mix needs it and cut into blocks of ``block_words`` words. Slot
j of the mix maps the golden-ratio point frac(j * phi) through the cumulative
target shares to a source; slots are ranked per source; slot rank r of a source
takes block r of its stream. A slot past the target is void and the block that
reaches it is cut there; where the points gave a source too few slots, the
missing ones follow at the end. So each source's words come to its target,
rounded, whatever the block size.

Built-in expressions and joins only. A hot source is never in one task: ranks
and word offsets are summed inside bounded blocks of rows and only one row per
block meets per source. The join of slots to documents is on (source, block),
which holds at most ``block_words`` documents with words.

Defined results: a null text has size 0; null is a source of its own, last in
order; documents of size 0 are taken 0 times; repeated rows are separate
documents; an empty table mixes to nothing; the schedule depends on ids, sizes
and sources alone, so reruns agree. Columns other than the three named are
ignored by the schedule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odometrix.llm.common import ROW, WORD, block_offsets, materialize, numbered, read_table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCK_WORDS = 512
ROWS_PER_BLOCK = 8192  # documents (or slots) whose running sum one task takes

PHI = 0.6180339887498949
_LOW = 1 << 20


def schedule_point(j, ratio: float = PHI):
    """frac(j * ratio), from two halves of j so that large j keep their digits."""
    low = (ratio * _LOW) % 1.0
    return ((F.floor(j / _LOW) * F.lit(low)) % 1.0 + ((j % _LOW) * F.lit(ratio)) % 1.0) % 1.0


def count_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized_documents(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """(row, id, source, size), written once: the row numbers stay fixed."""
    return materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            count_words(F.col(text_col)).alias("size"),
        ),
        "mix-sizes",
    )


def source_targets(
    sized: DataFrame, *, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(place, source, source_size, target, quota, lo, hi): one row per source.

    ``target`` shares all words by weight, none above ``max_epochs`` times its
    source's size. Sharing the excess again and again ends at one level: with
    sources in the order of cap / weight, the level is the largest of
    (words - caps before) / (weights from here on). ``quota`` is the target in
    whole words, [lo, hi) its share of the unit interval. The windows run over
    one row per source.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("place") % len(weights) + 1)
    named = (
        by_source.withColumn("place", place)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size").cast("double") * max_epochs)
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    whole = Window.partitionBy()
    before = F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")
    after = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    words = F.sum("source_size").over(whole).cast("double")
    by_place = Window.orderBy("place")
    return (
        named.withColumn("level", (words - before) / after)
        .withColumn("target", F.least(F.col("cap"), F.max("level").over(whole) * F.col("weight")))
        .withColumn("quota", F.round("target").cast("long"))
        .withColumn("_all", F.greatest(F.sum("quota").over(whole), F.lit(1)).cast("double"))
        .withColumn("hi", F.sum("quota").over(by_place.rowsBetween(Window.unboundedPreceding, 0)) / F.col("_all"))
        .withColumn("lo", F.coalesce(F.lag("hi").over(by_place), F.lit(0.0)))
        .select("place", "source", "source_size", "target", "quota", "lo", "hi")
    )


def slot_schedule(
    spark: SparkSession, targets: DataFrame, *, block_words: int = BLOCK_WORDS, ratio: float = PHI
) -> DataFrame:
    """(slot, place, rank): which source's block each slot of the mix takes."""
    stats = targets.agg(F.count(F.lit(1)).alias("n"), F.sum(F.ceil(F.col("quota") / block_words)).alias("slots"))
    n, slots = (int(x or 0) for x in stats.first())
    parts = max(1, -(-slots // (16 * ROWS_PER_BLOCK)))
    cells = max(1, 4 * n)
    j = F.col("id")
    points = (
        spark.range(0, slots, 1, parts)
        .withColumn("u", schedule_point(j, ratio))
        .withColumn("cell", F.floor(F.col("u") * cells).cast("int"))
    )
    # Each source covers the cells its interval touches: an equi-join on evenly
    # filled cells in place of a range join.
    shares = targets.filter("hi > lo").select(
        "place",
        "lo",
        "hi",
        F.explode(
            F.sequence(
                F.floor(F.col("lo") * cells).cast("int"),
                F.least(F.floor(F.col("hi") * cells).cast("int"), F.lit(cells - 1)),
            )
        ).alias("cell"),
    )
    drawn = (
        points.join(shares, "cell")
        .filter((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
        .select(F.col("id").alias("slot"), "place", F.floor(j / ROWS_PER_BLOCK).alias("stretch"))
    )
    ranked = materialize(
        block_offsets(drawn, ["place"], "stretch", [F.col("slot")], F.lit(1).cast("long"), "rank").select(
            "slot", "place", "rank"
        ),
        "mix-slots",
    )
    needed = F.ceil(F.col("quota") / block_words)
    counts = ranked.groupBy("place").agg(F.count(F.lit(1)).alias("have"))
    short = (
        targets.join(counts, "place", "left")
        .withColumn("have", F.coalesce(F.col("have"), F.lit(0)))
        .filter(F.col("have") < needed)
        .select("place", F.explode(F.sequence(F.col("have"), needed - 1)).alias("rank"))
        .select((F.lit(slots) + F.col("rank") * n + F.col("place")).alias("slot"), "place", "rank")
    )
    return ranked.unionByName(short)


def mix_schedule(
    sized: DataFrame,
    *,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    block_words: int = BLOCK_WORDS,
    ratio: float = PHI,
) -> tuple[DataFrame, DataFrame]:
    """(pieces, targets) of ``sized_documents``. A piece (slot, place, rank,
    epoch, row, start, length, place_in_slot) is a stretch of a document's words
    in a slot; slots in order, and pieces by their place in the slot, are the mix."""
    spark = sized.sparkSession
    targets = materialize(source_targets(sized, weights=weights, max_epochs=max_epochs), "mix-targets")
    slots = slot_schedule(spark, targets, block_words=block_words, ratio=ratio)

    rows = sized.count()
    blocks = max(1, -(-rows // (ROWS_PER_BLOCK // 2)))
    shuffled = F.xxhash64("id", "size")  # repeated ids with one size tie; row breaks the tie
    known = sized.join(
        targets.select(F.col("source").alias("_source"), "place", "source_size", "quota"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).withColumn("stretch", F.pmod(F.xxhash64("id", "size"), F.lit(blocks)))
    placed = block_offsets(
        known.filter("size > 0").drop("source", "_source"),
        ["place"],
        "stretch",
        [shuffled, F.col("row")],
        F.col("size"),
        "offset",
    )
    repeated = placed.withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1)))
    ).withColumn("begin", F.col("epoch") * F.col("source_size") + F.col("offset"))
    end = F.least(F.col("begin") + F.col("size"), F.col("quota"))
    taken = repeated.withColumn("end", end).filter("begin < end")
    cut = taken.withColumn(
        "rank",
        F.explode(F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words))),
    )
    lo = F.greatest(F.col("begin"), F.col("rank") * block_words)
    hi = F.least(F.col("end"), (F.col("rank") + 1) * block_words)
    pieces = cut.select(
        "row", "place", "rank", "epoch", (lo - F.col("begin")).alias("start"), (hi - lo).alias("length"),
        (lo - F.col("rank") * block_words).alias("place_in_slot"),
    ).join(slots, ["place", "rank"])
    return pieces.select("slot", "place", "rank", "epoch", "row", "start", "length", "place_in_slot"), targets


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: ``docs`` (columns doc_id, text, source and, where
    present, n_chars) with each document once per epoch that takes words of it,
    in the order of the mix: by the first slot that takes words of it, ranged
    over the partitions and sorted inside them. A document that its source's
    target cuts keeps the words taken, joined by single spaces; all others keep
    their text."""
    names = docs.columns
    rows = numbered(docs, "mix-docs")
    sized = materialize(
        rows.select(
            F.col(ROW).alias("row"), F.col("doc_id").alias("id"), "source", count_words(F.col("text")).alias("size")
        ),
        "mix-sizes",
    )
    pieces, _ = mix_schedule(sized, **options)
    uses = (
        pieces.groupBy("row", "epoch")
        .agg(
            F.sum("length").alias("_odx_taken"),
            F.min("slot").alias("_odx_slot"),
            F.min_by("place_in_slot", "slot").alias("_odx_place"),
        )
        .join(sized.select("row", "size"), "row")
        .select(
            F.col("row").alias(ROW), "_odx_taken", (F.col("_odx_taken") < F.col("size")).alias("_odx_cut"),
            "_odx_slot", "_odx_place",
        )
    )
    mixed = rows.join(uses, ROW)
    cut = F.col("_odx_cut")
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    text = F.when(
        cut, F.array_join(F.slice(words, F.lit(1), F.col("_odx_taken").cast("int")), " ")
    ).otherwise(F.col("text"))
    mixed = mixed.withColumn("text", text)
    if "n_chars" in names:
        mixed = mixed.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    # Only the piece that begins in a document's first slot can share it with others.
    order = ("_odx_slot", "_odx_place")
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select(*names)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = sized_documents(read_table(spark, sf_dir, "documents"))
    pieces, targets = mix_schedule(sized)
    taken = pieces.groupBy("row").agg(F.sum("length").alias("taken"), F.min("slot").alias("first_slot"))
    by_source = targets.select(F.col("source").alias("_source"), "source_size", "target")
    return (
        sized.join(by_source, F.col("source").eqNullSafe(F.col("_source")))
        .join(taken, "row", "left")
        .select(
            F.col("id").alias("doc_id"),
            "size",
            "source_size",
            "target",
            F.coalesce(F.col("taken"), F.lit(0)).cast("long").alias("taken"),
            "first_slot",
        )
    )
