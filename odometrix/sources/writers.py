"""Sinks. These are the only functions that run jobs."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.functions.columns import TIMESTAMP_FORMAT, as_timestamp
from odometrix.session import planned_partitions


def _hadoop(spark: SparkSession, path: str):
    """The Hadoop path and its file system: any store that Spark can write."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop(spark, path)
    return bool(fs.exists(target))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file's content, or None where there is none."""
    if not path_exists(spark, path):
        return None
    return "\n".join(r.value for r in spark.read.text(path).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file."""
    target, fs = _hadoop(spark, path)
    out = fs.create(target)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_overwrite(
    df: DataFrame, path: str, *, fmt: str = "parquet", partition_by: list[str] | None = None
) -> None:
    """K1: replace the dataset at ``path``."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


_CLAIM, _STAGE = ".odx-claim", ".odx-stage-"


class WriteInProgress(RuntimeError):
    """Another writer holds the claim on a path."""


def _create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless it exists, in one step; False where it does."""
    target, fs = _hadoop(spark, path)
    if fs.getScheme() == "file":  # Hadoop's local file system looks first and creates then
        local = spark._jvm.java.io.File(target.toUri().getPath())
        local.getParentFile().mkdirs()
        if not local.createNewFile():
            return False
        write_text(spark, path, text)
        return True
    try:
        out = fs.create(target, False)
    except Py4JJavaError as e:
        if fs.exists(target):
            return False
        raise e
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def _leftover(fs, target) -> bool:
    """A folder with nothing but the working folder of an unfinished write."""
    if not fs.getFileStatus(target).isDirectory():
        return False
    names = [f.getPath().getName() for f in fs.listStatus(target)]
    return names == ["_temporary"]


def write_once(
    df: DataFrame, path: str, *, fmt: str = "parquet", partition_by: list[str] | None = None
) -> bool:
    """K2: write ``df`` to ``path`` unless something is there; returns whether
    it wrote. What is there, whoever wrote it and in whatever format, is never
    replaced or deleted.

    One writer at a time: a claim file beside ``path`` is created if and only if
    there is none (:class:`WriteInProgress` if there is). The dataset is written
    to a staging folder beside ``path`` and published by one rename, so ``path``
    has a whole dataset or nothing. An interrupted job leaves its claim and its
    staging folder and no ``path``; :func:`release_claim` removes both. A folder
    that holds an unfinished write of some other tool is refused with an error.
    Stores without an atomic rename publish as well as they can rename."""
    spark = df.sparkSession
    path = path.rstrip("/")
    target, fs = _hadoop(spark, path)
    if fs.exists(target):
        if _leftover(fs, target):
            raise FileExistsError(f"{path} holds an unfinished write of another tool; remove it to write there")
        return False
    owner = uuid.uuid4().hex
    if not _create_new(spark, f"{path}{_CLAIM}", owner):
        if fs.exists(target):  # published meanwhile
            return False
        raise WriteInProgress(f"{path}{_CLAIM} is held; release_claim() if its job is dead")
    staged, _ = _hadoop(spark, f"{path}{_STAGE}{owner}")
    claim, _ = _hadoop(spark, f"{path}{_CLAIM}")
    try:
        if fs.exists(target):  # published between the look and the claim
            return False
        write_overwrite(df, staged.toString(), fmt=fmt, partition_by=partition_by)
        if read_text(spark, claim.toString()) != owner:
            raise WriteInProgress(f"the claim on {path} was released while this job was writing")
        if fs.exists(target):  # by a writer that takes no claims: a rename would move into it
            return False
        if not fs.rename(staged, target):
            raise OSError(f"could not publish {staged.toString()} as {path}")
        return True
    finally:
        fs.delete(staged, True)
        if read_text(spark, claim.toString()) == owner:
            fs.delete(claim, False)


def release_claim(spark: SparkSession, path: str) -> bool:
    """Remove the claim that a dead job left on ``path``, and its staging folder;
    returns whether there was one. Datasets are not touched."""
    path = path.rstrip("/")
    owner = read_text(spark, f"{path}{_CLAIM}")
    if owner is None:
        return False
    claim, fs = _hadoop(spark, f"{path}{_CLAIM}")
    if owner:
        staged, _ = _hadoop(spark, f"{path}{_STAGE}{owner}")
        fs.delete(staged, True)
    fs.delete(claim, False)
    return True


_VERSIONS, _ASIDE, _PARTITION_CONF = "__odx_versions", "__odx_aside", "spark.sql.hive.manageFilesourcePartitions"


def _versions_dir(spark: SparkSession, name: str) -> str:
    db, _, table = name.rpartition(".")
    root = spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri
    return f"{root.rstrip('/')}/{table}{_VERSIONS}"


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0].data_type


def _plain_path(path: str) -> str:
    """A path without scheme and authority, to compare locations by."""
    return re.sub(r"^[a-z0-9+.-]+:(//[^/]*)?", "", path).rstrip("/")


def recover_gold(spark: SparkSession, name: str) -> bool:
    """Finish a replacement with another schema that was cut off between its two
    renames: the old table gets its name back. Returns whether it had lost it."""
    aside = f"{name}{_ASIDE}"
    if not spark.catalog.tableExists(aside):
        return False
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE {aside}")
        return False
    spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
    return True


def _create_over(spark: SparkSession, name: str, location: str, fmt: str, partition_by: list[str] | None) -> None:
    """A table over a folder. Its partitions are found in the folder, not kept in
    the catalog, so that one change of location moves all of them."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.format(fmt).load(location).schema.fields
    )
    by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    kept = spark.conf.get(_PARTITION_CONF)
    spark.conf.set(_PARTITION_CONF, "false")
    try:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} {by} LOCATION '{location}'")
    finally:
        spark.conf.set(_PARTITION_CONF, kept)


def save_gold(
    df: DataFrame, name: str, *, fmt: str = "parquet", partition_by: list[str] | None = None
) -> str:
    """K3: create or replace a named table from a query (CTAS), atomically.
    Returns the folder of the new version.

    The rows are written aside, to a new folder of the table's versions; then one
    catalog statement (``SET LOCATION``) commits it. A job killed before that
    leaves the old table whole, and readers that began on the old version finish
    on it: old folders stay until :func:`vacuum_gold`. So a query may read the
    table that it replaces. A replacement with other columns or partitions, which
    a V1 catalog cannot take in one statement, renames the old table aside and the
    new one in; cut off between the two, the next call (or :func:`recover_gold`)
    brings the old one back."""
    spark = df.sparkSession
    recover_gold(spark, name)
    version = f"{_versions_dir(spark, name)}/v-{uuid.uuid4().hex}"
    write_overwrite(df, version, fmt=fmt, partition_by=partition_by)
    if not spark.catalog.tableExists(name):
        _create_over(spark, name, version, fmt, partition_by)
        return version
    old = spark.table(name).schema
    new = spark.read.format(fmt).load(version).schema
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    same = [(f.name, f.dataType) for f in old] == [(f.name, f.dataType) for f in new]
    ours = _plain_path(_location(spark, name)).startswith(_plain_path(_versions_dir(spark, name)) + "/")
    if same and ours and parts == list(partition_by or []) and _provider(spark, name) == fmt:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
        return version
    fresh, aside = f"{name}__odx_fresh", f"{name}{_ASIDE}"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    _create_over(spark, fresh, version, fmt, partition_by)
    spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    spark.sql(f"DROP TABLE {aside}")
    return version


def _provider(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Provider'").collect()
    return rows[0].data_type.lower()


def vacuum_gold(spark: SparkSession, name: str, *, keep: int = 1) -> int:
    """Delete old versions of a table that :func:`save_gold` wrote, but for the
    current one and the ``keep`` latest others; returns how many. Not to be run
    beside a writer of the table or readers of older versions."""
    root, fs = _hadoop(spark, _versions_dir(spark, name))
    if not fs.exists(root):
        return 0
    now = _plain_path(_location(spark, name)) if spark.catalog.tableExists(name) else None
    old = [
        f for f in fs.listStatus(root)
        if f.getPath().getName().startswith("v-") and _plain_path(f.getPath().toString()) != now
    ]
    old.sort(key=lambda f: f.getModificationTime(), reverse=True)
    for f in old[keep:]:
        fs.delete(f.getPath(), True)
    return len(old[keep:])


def write_sensor_json(
    df: DataFrame,
    path: str,
    *,
    key: str = "vehicle_id",
    ts: str = "timestamp",
    date_name: str = "date",
    max_records_per_file: int = 1_000_000,
) -> None:
    """K5: readings as JSON lines under ``<key>=<k>/<date>=<d>/``, timestamps
    in the raw layout ``yyyy-MM-dd HH:mm:ss``.

    Rows are range-partitioned on (key, date, ts): each task writes few
    directories, and a (key, day) that holds a large share of the rows is
    spread over several tasks and files instead of one. Partition columns
    leave the records and come back from the path on read.
    """
    dated = df.withColumn(date_name, F.to_date(as_timestamp(df, ts)))
    n = planned_partitions(df.sparkSession)
    (
        dated.repartitionByRange(n, key, date_name, ts)
        .sortWithinPartitions(key, date_name, ts)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .partitionBy(key, date_name)
        .json(path)
    )
