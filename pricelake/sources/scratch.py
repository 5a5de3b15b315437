"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; it goes when the driver ends.

    Where the setting is absent a local master gets a temporary folder; a cluster does not, because
    each of its executors would write to a disk of its own.
    """
    context = spark.sparkContext
    base = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pricelake-"))
        base = context.getCheckpointDir()
    folder = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored_once(df: DataFrame, name: str) -> DataFrame:
    """The rows written and read back: computed once, and safe from lost executors."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
