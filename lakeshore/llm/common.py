"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words; bytes.split() splits UTF-8 text at the same characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset a session of one process (tests)
    gets a local one, and any other an error."""
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not told:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir has to name a folder that the executors of {master} share")
        told = tempfile.mkdtemp(prefix="spark-checkpoints-")
        spark.sparkContext.setCheckpointDir(told)
    return told.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system that Spark takes it for, so that other readers open the same files."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    told = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return re.sub("^file:/+", "file:///", told)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def released(spark: SparkSession) -> None:
    """Let Spark drop the shuffles and broadcasts of rounds that are over, on executors too: it learns of them only when the driver's
    garbage is collected, which may not be for many rounds."""
    spark.sparkContext._jvm.System.gc()


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a folder that no later step reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def dealt_anew(df: DataFrame, key: str) -> DataFrame:
    """`df`, often an aggregate by `key` (a long or a string), with the key as an expression: a join on it then exchanges both
    sides, and adaptive execution can split a key with many rows. Joined as it is, the aggregate's own partitioning would
    be kept and each key be one task's."""
    same = F.concat(F.col(key), F.lit("")) if dict(df.dtypes)[key] == "string" else F.col(key).bitwiseXOR(F.lit(0).cast("long"))
    return df.withColumn(key, same)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it while the frame has such a column."""
    while name in df.columns:
        name = f"_{name}"
    return name


def parallelism(df: DataFrame) -> int:
    return max(2 * df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that `column` holds about most_bytes at most in each; a longer single text stays whole."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


def two_hashes(text: Column, *more: Column) -> Column:
    """128 bits from built-in functions: two 64-bit hashes with different seeds."""
    return F.struct(F.xxhash64(text, *more).alias("a"), F.xxhash64(F.lit(7), text, *more).alias("b"))


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case, and no other letter changed; null stays null."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))
