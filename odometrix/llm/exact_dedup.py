"""Exact deduplication by skew-safe combining.

Texts are equal when identical after lower-casing A-Z. Three grouping stages,
each of which compares the full text beside its SHA-256: rows of one input
task (map-side partial aggregation), rows of one (digest, salt), and the salt
winners of one digest. A group of copies of any size therefore reaches its
last stage as at most ``salts`` rows. Rows are then joined back to their class
on the 32-byte digest alone; only if two different texts ever shared a digest
are those rows joined on digest and text.

Defined results: a null text counts as empty and equals other empty texts; a
null id is smaller than any other; among fully repeated rows that tie for the
largest id exactly one is kept; an empty table gives an empty result; columns
other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.llm.common import ROW, ascii_lower, materialize, numbered, read_table

SALTS = 32


def sha256_of(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256_of,
) -> DataFrame:
    """One row per input row: ``id``, ``keep_id`` (the largest id among equal
    texts), ``group_size``, ``kept``, ``text_sha256``. ``digest`` may be any
    function of the normalised text: collisions cost time, never correctness.
    """
    texts = docs.select(
        F.col(id_col).alias("id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("norm")
    ).withColumn("digest", digest(F.col("norm")))

    by_digest = materialize(
        _classes(texts, salts)
        .groupBy("digest")
        .agg(
            F.count(F.lit(1)).alias("n_texts"),
            F.max("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
        ),
        "exact-digests",
    )
    ids = texts.withColumn("text_sha256", sha256_of(F.col("norm")))
    rows = ids.drop("norm").join(by_digest.filter("n_texts = 1").drop("n_texts"), "digest")
    collided = by_digest.filter("n_texts > 1").select("digest")
    if not collided.isEmpty():
        shared = ids.join(collided, "digest")
        rows = rows.unionByName(
            shared.join(_classes(shared.drop("text_sha256"), salts), ["digest", "norm"]).drop("norm")
        )
    return _mark_kept(rows.drop("digest")).withColumnRenamed("id", id_col)


def _classes(texts: DataFrame, salts: int) -> DataFrame:
    """(digest, norm, keep_id, group_size): one row per different text."""
    # Salted by task: whatever copies a task holds, it hands on one of each text.
    salted = texts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    winners = salted.groupBy("digest", "salt", "norm").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    # At most ``salts`` rows a text are left. Dealt by digest alone, so that the
    # count of texts per digest needs no further exchange of the texts.
    return (
        winners.repartition("digest")
        .groupBy("digest", "norm")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )


def _mark_kept(rows: DataFrame) -> DataFrame:
    """``kept`` on one row per class. Rows tied for the largest id (repeated
    rows) are told apart by a row number that the written table fixes."""
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "exact-rows")
    top = F.col("id").eqNullSafe(F.col("keep_id"))
    tied = (
        rows.filter(top & (F.col("group_size") > 1))
        .groupBy("text_sha256", "keep_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("row").alias("chosen"))
        .filter("n > 1")
    )
    kept = top
    if not tied.isEmpty():
        tied = tied.select("text_sha256", "keep_id", "chosen")
        on = rows["text_sha256"].eqNullSafe(tied["text_sha256"]) & rows["keep_id"].eqNullSafe(tied["keep_id"])
        rows = rows.join(tied, on, "left").select(rows["*"], "chosen")
        kept = top & F.coalesce(F.col("chosen") == F.col("row"), F.lit(True))
    return rows.select("id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def exact_dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the one row of every class that stays."""
    rows = numbered(docs, "exact-docs")
    # The row's name makes every id different; nulls come before all other ids.
    ids = rows.select(F.struct(F.col(id_col).alias("id"), ROW).alias("id"), F.col(text_col).alias("text"))
    kept = exact_dedup(ids, "id", "text").filter("kept").select(F.col(f"id.{ROW}").alias(ROW))
    return rows.join(kept, ROW, "left_semi").select(*docs.columns)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


# Upper and lower case as DuckDB's translate() takes them.
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP10_SQL = f"""
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), {_AZ}) AS norm FROM documents
), g AS (
  SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) AS place
  FROM t
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM g
"""
