"""Incremental landing of the raw sensor drop.

The raw generator writes one JSON file per vehicle and day and calls its
first load a "beginning batch". This lands such a drop incrementally: a file
stream over the directory, typed to silver by the same ``to_silver_sensor``
projection as the batch path, appended to a parquet table partitioned by
day. Progress lives in the checkpoint the caller names; one checkpoint belongs
to one raw directory and one target, and a call that would mix them up, and so
lose data without a word, fails.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from odometrix.operators.ingest import to_silver_sensor
from odometrix.schemas import RAW_SENSOR
from odometrix.session import planned_partitions
from odometrix.sources.writers import path_exists, read_text, write_text


OWNER = "odometrix-owner"


def _claim(spark: SparkSession, raw_dir: str, silver_path: str, checkpoint: str) -> None:
    """Tie ``checkpoint`` to its source and target, or refuse. A checkpoint with
    another target would skip what it landed there; a fresh one for a target
    that a stream has written would have its first batches dropped by the sink."""
    owner = f"{raw_dir} -> {silver_path}"
    known = read_text(spark, f"{checkpoint}/{OWNER}")
    if known is not None and known != owner:
        raise ValueError(f"checkpoint {checkpoint} belongs to {known}, not to {owner}")
    if known is None and path_exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"checkpoint {checkpoint} belongs to another stream")
    if known is None and path_exists(spark, f"{silver_path}/_spark_metadata"):
        raise ValueError(f"{silver_path} was written by a stream with another checkpoint")
    if known is None:
        write_text(spark, f"{checkpoint}/{OWNER}", owner)


def land_sensor_stream(
    spark: SparkSession,
    raw_dir: str,
    silver_path: str,
    checkpoint: str,
    *,
    available_now: bool = True,
    interval: str = "1 minute",
    max_files_per_trigger: int | None = None,
    query_name: str | None = None,
    files_per_day: int | None = None,
) -> StreamingQuery:
    """Start the stream. ``checkpoint`` is a folder all executors share. With
    ``available_now`` it lands every file present and stops (call
    ``awaitTermination()``), otherwise it polls every ``interval``. A batch's day is
    dealt to ``files_per_day`` tasks (by default as many as the session plans
    partitions), each of which writes a file if vehicles fall to it."""
    reader = spark.readStream.schema(RAW_SENSOR).option("multiLine", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    silver = to_silver_sensor(reader.json(raw_dir)).withColumn("date", F.to_date("timestamp"))
    salts = files_per_day or planned_partitions(spark)
    silver = silver.repartition("date", F.pmod(F.xxhash64("vehicle_id", "timestamp"), F.lit(salts)))
    _claim(spark, raw_dir, silver_path, checkpoint)
    writer = (
        silver.writeStream.format("parquet")
        .option("path", silver_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date")
        .outputMode("append")
    )
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=interval
    )
    return writer.start()
