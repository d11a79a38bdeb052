"""Cutting lineage with tables written to the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; only where it is unset (tests, a single machine) a folder of our own, removed
    when Python ends.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="tesselex-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return "file://" + _OWN[0]


_WRITTEN: list[str] = []


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder, deleted by `clean`."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as a parquet table in the shared folder and read back: a lost executor costs a read, not the whole lineage."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> int:
    """Deletes the tables this process has written so far and tells how many. Results that still read them must have been saved."""
    jvm, n = spark._jvm, len(_WRITTEN)
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = root + (os.pathsep + have if have else "")
    return spark
