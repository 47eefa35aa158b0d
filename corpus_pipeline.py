"""The training-data pipeline: documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.llm.common import materialize, read_table
from odometrix.llm.exact_dedup import exact_dedup_rows
from odometrix.llm.mixing import mix_documents
from odometrix.llm.packing import pack_documents
from odometrix.llm.quality import clean_lines
from odometrix.llm.simhash import near_distinct


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; of the others, failing lines are removed."""
    found = "_odx_quality"
    cut = F.col(f"{found}.lost_words") > 0
    text = F.when(cut, F.col(f"{found}.clean_text")).otherwise(F.col("text"))
    kept = clean_lines(docs, out_col=found).filter(f"{found}.kept")
    n_chars = F.when(cut, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumns({"text": text, "n_chars": n_chars}).select(*docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints the document with the smallest doc_id stays."""
    return near_distinct(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once per epoch in which its source's target takes it."""
    return mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and offset."""
    return pack_documents(docs).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# SimHash components, hashed stream orders and packings have no SQL form;
# tests/llm/test_pipeline.py holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
