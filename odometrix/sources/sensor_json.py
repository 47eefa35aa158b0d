"""Raw sensor drop: a directory of JSON files, one per vehicle and day, each an
indented top-level array of readings (SURVEY S1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odometrix.schemas import RAW_SENSOR


CORRUPT = "_corrupt_record"


def _read(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """Every record with its text where it could not be read."""
    schema = T.StructType([*RAW_SENSOR.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )


def read_sensor_json(
    spark: SparkSession,
    path: str,
    *,
    with_file_name: bool = False,
    multi_line: bool = True,
    on_corrupt: str = "fail",
) -> DataFrame:
    """One row per reading, under the declared raw schema.

    ``multi_line=True`` reads the generator's layout: each file one indented
    array. Such a file cannot be split, so one task parses it whole; many
    small files parallelise, one huge file does not, so land the data as
    parquet (``to_silver_sensor``) early. ``multi_line=False`` reads JSON
    lines -- the layout ``write_sensor_json`` produces -- which Spark splits
    into blocks of ``spark.sql.files.maxPartitionBytes``. ``with_file_name``
    adds the source file name (``<vehicle>_<date>.json``) as ``source_file``.

    A record that cannot be read (a truncated file, a value of another type)
    ends the job by default; ``on_corrupt="skip"`` leaves it out, and
    :func:`corrupt_sensor_records` lists what was left out. It never becomes a
    row of NULLs.
    """
    if on_corrupt not in ("fail", "skip"):
        raise ValueError("on_corrupt must be 'fail' or 'skip'")
    if on_corrupt == "skip":
        # Spark refuses a scan of the corrupt column alone, as under a bare count:
        # the second condition always holds and reads a data column.
        read = F.coalesce(F.length("vehicle_id"), F.lit(0)) >= 0
        df = _read(spark, path, multi_line).filter(F.col(CORRUPT).isNull() & read).drop(CORRUPT)
        return df if with_file_name else df.drop("source_file")
    df = spark.read.schema(RAW_SENSOR).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    return df.withColumn("source_file", F.col("_metadata.file_name")) if with_file_name else df


def corrupt_sensor_records(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """``source_file, record``: what ``on_corrupt="skip"`` leaves out, for a
    quarantine table."""
    read = F.coalesce(F.length("vehicle_id"), F.lit(0)) >= 0  # as in read_sensor_json
    bad = _read(spark, path, multi_line).filter(F.col(CORRUPT).isNotNull() & read)
    return bad.select("source_file", F.col(CORRUPT).alias("record"))


def read_indented_array(
    spark: SparkSession, path: str, schema: T.StructType = RAW_SENSOR, *, indent: int = 4, on_corrupt: str = "fail"
) -> DataFrame:
    """Files of one indented top-level array each (the generator's layout), read in
    splits: one huge file is parsed by many tasks.

    A record ends at a line that holds nothing but ``indent`` spaces and a closing
    brace (any inner one stands deeper, and line breaks inside strings are escaped),
    so that line separates the records of a text scan, and Spark cuts the file at
    any of them. A file in another layout has no such lines and fails, or with
    ``on_corrupt="skip"`` gives no rows, as does a truncated last record."""
    if on_corrupt not in ("fail", "skip"):
        raise ValueError("on_corrupt must be 'fail' or 'skip'")
    close = "\n" + " " * indent + "}"
    chunks = spark.read.option("lineSep", close).text(path)
    body = F.regexp_replace("value", r"^\s*[\[,]?\s*", "")
    left = F.regexp_replace("value", r"[\s\[\]]", "")  # what stands before, between and after records
    records = chunks.filter(left != "").select(F.concat(body, F.lit(close)).alias("record"))
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    read = F.from_json("record", wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = records.select(read.alias("r")).select("r.*")
    bad = F.col(CORRUPT).isNotNull()
    if on_corrupt == "skip":
        return rows.filter(~bad).drop(CORRUPT)
    message = F.concat(F.lit("not a record of an indented array: "), F.substring(CORRUPT, 1, 200))
    first = schema.fields[0]
    checked = F.when(bad, F.raise_error(message).cast(first.dataType)).otherwise(F.col(first.name))
    return rows.withColumn(first.name, checked).drop(CORRUPT)
