"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odometrix.session import shared_dir

# A word: code points other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet``; any file system Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back:
    cuts the lineage, survives lost executors, fixes non-deterministic ids."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/odometrix-llm/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROW = "_odx_row"


def _is_plain_scan(docs: DataFrame) -> bool:
    """Whether ``docs`` is a scan of files, none of them listed twice."""
    plan = docs._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return False
    relation = plan.relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation":
        return False
    different = docs._jdf.inputFiles()  # only their numbers reach Python
    return len(relation.location().inputFiles()) == len(different)


def numbered(docs: DataFrame, label: str) -> DataFrame:
    """``docs`` with a struct ``_odx_row`` that names every row and stays the same
    in each read. Rows of a plain file scan are named by file and place in it;
    any other input, and a scan that lists a file twice, is written once, so that
    its row numbers stay."""
    if _is_plain_scan(docs) and "_metadata" not in docs.columns:
        row = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
        return docs.select("*", row.alias(ROW))
    row = F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("place"))
    return materialize(docs.withColumn(ROW, row), label)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver runs from:
    Spark sends them the package's sources, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_odometrix_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="odometrix-src-"), "odometrix_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._odometrix_shipped = True


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # On pure ASCII text Spark's lower() is the same function and much faster.
    is_ascii = F.length(text) == F.octet_length(text)
    return F.when(is_ascii, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row: a lambda
    variable, which the optimizer cannot inline into an inner loop."""
    return F.transform(F.array(value), body)[0]


_RUN = 256  # elements summed in one go by array_prefix_sums


def array_prefix_sums(steps: Column) -> Column:
    """Inclusive running sums of an array of longs, as an expression.
    Blocked, so n elements cost about n * 256 / 2 + (n / 256)^2 / 2 additions
    instead of n^2 / 2."""

    def run(a: Column) -> Column:
        size = F.size(a)
        zero = F.lit(0).cast("long")

        def add(part: Column) -> Column:
            return F.aggregate(part, zero, lambda s, x: s + x)

        totals = F.transform(
            F.sequence(F.lit(0), F.floor((size - 1) / _RUN).cast("int")),
            lambda c: add(F.slice(a, c * _RUN + 1, _RUN)),
        )
        before = let(totals, lambda t: F.transform(t, lambda _, c: add(F.slice(t, F.lit(1), c))))
        sums = let(
            before,
            lambda b: F.transform(
                a,
                lambda _, i: F.get(b, F.floor(i / _RUN).cast("int"))
                + add(F.slice(a, (F.floor(i / _RUN) * _RUN + 1).cast("int"), (i % _RUN + 1).cast("int"))),
            ),
        )
        return F.when(size > 0, sums).otherwise(F.array().cast("array<bigint>"))

    return let(steps, run)


def block_offsets(
    df: DataFrame, keys: Sequence[str], block: str, order: Sequence[Column], amount: Column, total: str
) -> DataFrame:
    """Exclusive running sum of ``amount`` over rows of equal ``keys`` in the
    order (``block``, ``order``), as column ``total``, without a hot key in
    one task: rows are summed inside (keys, block); only one row per block
    meets in the window over a key. ``block`` must be non-null, and a function
    of the row that splits every key into bounded blocks. Key values may be
    null.
    """
    sub, inner, before = "_odx_block_sum", "_odx_inner", "_odx_before"
    df = df.withColumn("_odx_amount", amount)
    w_in = Window.partitionBy(*keys, block).orderBy(*order)
    df = df.withColumn(inner, F.sum("_odx_amount").over(w_in.rowsBetween(Window.unboundedPreceding, 0)))
    df = df.withColumn(inner, F.col(inner) - F.col("_odx_amount"))
    sums = df.groupBy(*keys, block).agg(F.sum("_odx_amount").alias(sub))
    w_of = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn(before, F.sum(sub).over(w_of) - F.col(sub)).drop(sub)
    renamed = sums.select(*[F.col(k).alias(f"_odx_k_{k}") for k in (*keys, block)], before)
    on = F.lit(True)
    for k in (*keys, block):
        on = on & F.col(k).eqNullSafe(F.col(f"_odx_k_{k}"))
    joined = df.join(renamed, on)
    return joined.withColumn(total, F.col(before) + F.col(inner)).drop(
        inner, before, "_odx_amount", *[f"_odx_k_{k}" for k in (*keys, block)]
    )
