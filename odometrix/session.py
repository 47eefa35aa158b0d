"""Session settings the operators are designed for."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Defaults for settings that neither the caller nor the submission names.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    app: str = "odometrix", *, master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """The running session as it is, or a new one with :data:`DEFAULTS` for
    every setting that the submission (``--conf``, ``--master``,
    ``spark-defaults.conf``) leaves open. ``master`` and ``shuffle_partitions``
    count only where the submission names none; nothing is assumed about
    memory, fan-out or master."""
    running = SparkSession.getActiveSession()
    if running is not None:
        return running
    SparkContext._ensure_initialized()  # so that SparkConf sees the submission
    given = SparkConf()
    wanted = dict(DEFAULTS)
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    log_dir = os.environ.get("ODX_EVENT_LOG_DIR")
    if log_dir:  # stage and task times without the UI: read the JSON event log
        wanted["spark.eventLog.enabled"] = "true"
        wanted["spark.eventLog.dir"] = log_dir
        wanted["spark.eventLog.compress"] = "false"
    b = SparkSession.builder
    if master and given.get("spark.master", "local[*]") == "local[*]":  # what a bare submission gets
        b = b.master(master)
    if not given.contains("spark.app.name"):
        b = b.appName(app)
    for k, v in wanted.items():
        if not given.contains(k):
            b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def planned_partitions(spark: SparkSession) -> int:
    """The shuffle fan-out the session plans for: the larger of
    ``spark.sql.shuffle.partitions`` and AQE's
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` (which
    clusters set high and let adaptive execution coalesce down)."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    if initial not in (None, "", "None"):
        n = max(n, int(initial))
    return max(1, n)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where
    it is unset a session on one machine gets a temporary folder; a cluster must
    name one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="odometrix-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base
