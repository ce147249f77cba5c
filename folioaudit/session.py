"""Spark session settings the audit is designed for."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Dates and timestamps mean the same on every machine.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: join choice by measured size, skewed partitions split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Text shrinks well in a shuffle and each row is work: split early.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Of duplicate keys in a JSON object the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Checkpoints that nothing refers to any more are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """Get or create a session with the audit's settings; ``extra`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; only a local run may make one."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is not None:
        return
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="audit-checkpoint-", dir=os.environ.get("TMPDIR")))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def stored(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the shared folder: fixed rows and a short plan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all sessions of the cluster share."""
    ensure_checkpoint_dir(spark)
    # Each session's checkpoints lie in a folder of their own below it.
    return spark.sparkContext.getCheckpointDir().rstrip("/").rsplit("/", 1)[0]


def _hadoop(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


class Scratch:
    """Stored stages of one job, in the shared folder.

    A job with a name finds the stages that an earlier try of it completed.
    """

    def __init__(self, spark: SparkSession, job_id: str | None = None) -> None:
        self.spark, self.named, self.count = spark, job_id is not None, 0
        if self.named:
            self.folder = f"{shared_folder(spark)}/audit-job-{job_id}"
        else:
            ensure_checkpoint_dir(spark)
            self.folder = f"{spark.sparkContext.getCheckpointDir()}/job-{uuid.uuid4().hex}"

    def holds(self, stage: str) -> bool:
        """Whether the stage was written to its end."""
        fs, path = _hadoop(self.spark, f"{self.folder}/{stage}/_SUCCESS")
        return self.named and fs.exists(path)

    def store(self, rows: DataFrame | Callable[[], DataFrame], stage: str | None = None) -> DataFrame:
        """Write ``rows`` and read them back: fixed rows, short lineage, columns pruned.

        A function is called only if the stage has to be written.
        """
        self.count += 1
        stage = stage or str(self.count)
        path = f"{self.folder}/{stage}"
        if self.holds(stage):
            return self.spark.read.parquet(path)
        df = rows() if callable(rows) else rows
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        fs, path = _hadoop(self.spark, self.folder)
        fs.delete(path, True)


@contextmanager
def scratch(spark: SparkSession, job_id: str | None = None):
    """A ``Scratch`` that is removed in the end: it may hold personal data.

    After a failure it is removed too, unless the job has a name to be resumed by.
    """
    held = Scratch(spark, job_id)
    done = False
    try:
        yield held
        done = True
    finally:
        if done or not held.named:
            held.remove()


@contextmanager
def exclusive(spark: SparkSession, name: str, lease_seconds: int):
    """One holder of ``name`` at a time, across sessions, by a file in the shared folder.

    The folder's file system has to create files atomically, as HDFS does. A
    file older than the lease was left by a lost driver and is taken over.
    """
    fs, path = _hadoop(spark, f"{shared_folder(spark)}/audit-lock-{name}")
    while not _created(fs, path):
        if _age(fs, path) > lease_seconds:
            fs.delete(path, False)
        else:
            time.sleep(0.5)
    try:
        yield
    finally:
        fs.delete(path, False)


def _created(fs, path) -> bool:
    try:
        return fs.createNewFile(path)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise


def _age(fs, path) -> float:
    """Seconds since the file was written; 0 if it has just gone."""
    try:
        return time.time() - fs.getFileStatus(path).getModificationTime() / 1000
    except Py4JJavaError as error:
        if "FileNotFound" in error.java_exception.getClass().getName():
            return 0.0
        raise
