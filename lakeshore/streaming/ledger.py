"""A ledger of a stream's batches: what a batch has written to a table, and which partitions a later job has yet to read.

The ledger of a table is a table beside it. A batch is entered when it begins, and again, with a row for each partition that it
wrote to, when it is done; the rows of a batch are marked with its name. So a batch that comes again either does nothing or
takes away what its broken predecessor has left.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import append_table, appended, in_partitions, merge_table, overwrite_partitions

BATCH = "_batch"
#: How far the clocks of the driver and of the files may differ before more files than a batch's own are read for its counts.
CLOCKS = datetime.timedelta(hours=1)
SCHEMA = "query string, epoch long, state string, part string, n_rows long"


def ledger_of(table: str) -> str:
    return f"{table}__batches"


def _entries(spark: SparkSession, table: str) -> DataFrame:
    name = ledger_of(table)
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], SCHEMA)


def _enter(spark: SparkSession, table: str, rows: list[tuple]) -> None:
    append_table(spark.createDataFrame(rows, SCHEMA).coalesce(1), ledger_of(table))


def _taken_away(spark: SparkSession, table: str, name: str, rows: DataFrame, column: str) -> None:
    """Remove what a broken batch has left: only the partitions that its rows belong to are read and written."""
    if not spark.catalog.tableExists(table):
        return
    values = {tuple(r) for r in rows.select(column).distinct().collect()}
    there = in_partitions(spark.table(table), [column], values)
    if not there.where(F.col(BATCH) == name).isEmpty():
        overwrite_partitions(there.where(F.col(BATCH) != name), table, values)


def _sizes(spark: SparkSession, table: str, name: str, column: str, values: set[tuple], since: datetime.datetime, n: int) -> list:
    """(part, count) of a batch that is in the table, so that its rows needn't be made twice or kept for this.

    Only its partitions are listed, and only their new files are read; all of them where the files' clock is so far behind that rows are missing.
    """
    own = in_partitions(spark.table(table), [column], values).where(F.col(BATCH) == name)
    count = lambda df: df.groupBy(F.col(column).cast("string").alias("part")).count().collect()  # noqa: E731  # partitions of one batch
    new = count(own.where(F.col("_metadata.file_modification_time") >= F.lit(since)))
    return new if sum(r["count"] for r in new) == n else count(own)


def append_once(rows: DataFrame, epoch: int, table: str, query: str, partition_by: str) -> int:
    """Append a batch's rows, marked with its query and epoch, unless the ledger has it as done. The number of rows appended.

    A batch that comes again has the same rows, as its source's offsets say. An empty one is entered, too, and makes no table.
    """
    spark, name = rows.sparkSession, f"{query}/{epoch}"
    states = {r["state"] for r in _entries(spark, table).where((F.col("query") == query) & (F.col("epoch") == epoch)).select("state").distinct().collect()}
    if "done" in states:
        return 0
    marked = rows.withColumn(BATCH, F.lit(name))
    if "begun" in states:
        _taken_away(spark, table, name, marked, partition_by)
    else:
        _enter(spark, table, [(query, epoch, "begun", None, None)])
    since = datetime.datetime.now(datetime.UTC) - CLOCKS
    got = appended(marked, table, [partition_by], None, F.collect_set(F.struct(partition_by)).alias("parts"))
    sizes = _sizes(spark, table, name, partition_by, {tuple(v) for v in got["parts"]}, since, got["n_rows"]) if got["n_rows"] else []
    _enter(spark, table, [(query, epoch, "done", r["part"], r["count"]) for r in sizes] or [(query, epoch, "done", None, 0)])
    return got["n_rows"]


def marks_of(target: str) -> str:
    return f"{target}__read"


def due(spark: SparkSession, table: str, target: str) -> DataFrame:
    """(query, epoch, part) of the done batches with rows in `table` that `target` hasn't read yet, by the marks beside it."""
    done = _entries(spark, table).where("state = 'done' and n_rows > 0").select("query", "epoch", "part")
    if not spark.catalog.tableExists(marks_of(target)):
        return done
    marks = spark.table(marks_of(target)).select("query", F.col("epoch").alias("upto"))
    return done.join(marks, "query", "left").where("upto is null or epoch > upto").drop("upto")


def read_due(spark: SparkSession, table: str, target: str, job: Callable[[list[str]], int]) -> int:
    """Run a job on the partitions that got rows since target last read them, however old these are; then mark them as read.

    A run that fails leaves the marks, so the next one does its partitions again: the job has to bear that, as a merge does.
    """
    waiting = due(spark, table, target).persist()
    try:
        parts = sorted(r[0] for r in waiting.where("part is not null").select("part").distinct().collect())  # a table's partitions
        n = job(parts) if parts else 0
        merge_table(waiting.groupBy("query").agg(F.max("epoch").alias("epoch")), marks_of(target), ["query"], update=True)
        return n
    finally:
        waiting.unpersist()
