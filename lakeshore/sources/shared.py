"""The folder that driver and executors share, and what is kept in it for a while."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where that is unset a session of one process (tests) gets a local one, any other an error."""
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not told:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir has to name a folder that the executors of {master} share")
        told = tempfile.mkdtemp(prefix="spark-shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(told)
    return told.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as they are now, whatever happens to the tables that they come from."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
