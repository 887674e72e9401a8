"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime
from functools import cache

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str, master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # window state lives off-heap and is uploaded as change logs, not whole snapshots
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def utc(spark: SparkSession) -> Iterator[None]:
    """Queries built inside render and read log times in UTC, whatever zone the session
    came with; the session keeps its own."""
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "UTC")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver may fall back to a temporary
    folder: on a cluster a path on one machine is not visible to the executors and is lost
    with its node.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/hitwatch/{purpose}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, whoever reads it and
    whatever executor is lost."""
    path = work_dir(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _located(spark: SparkSession, path: str) -> tuple:
    """A path and the file system it is on, as Hadoop has them."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder by the file system it is on."""
    target, files = _located(spark, path)
    files.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    target, files = _located(spark, path)
    files.mkdirs(target)


def make_file(spark: SparkSession, path: str) -> None:
    """An empty file under a new name."""
    target, files = _located(spark, path)
    if not files.createNewFile(target):
        raise FileExistsError(path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    target, files = _located(spark, path)
    return files.getContentSummary(target).getLength()


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a file or folder; the new name must be free."""
    source, files = _located(spark, path)
    if not files.rename(source, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot move {path} to {to}")


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of files and folders in a folder, sorted; none if there is no such folder."""
    target, files = _located(spark, path)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target))


@contextmanager
def state_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """Queries started inside keep their state in ``count`` partitions, by default as many
    as ``spark.sql.shuffle.partitions`` says. The first checkpoint fixes the number for the
    life of a query, so it is a setting and not taken from the cores of the moment."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(count or before))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_name() -> str:
    """Folder name of one run of a job; names sort by start time."""
    return f"run-{datetime.now():%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
