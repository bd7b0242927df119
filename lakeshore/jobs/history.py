"""A history table: one partition of open versions, and one of closed versions for each load. A merge reads open versions only."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import enforced
from ..operators.upsert import repeated_keys
from ..sources.sinks import create_table, overwrite_partitions, replace_where, rules_of

#: The partition column: the load that closed a version, or OPEN.
CLOSED_IN, OPEN = "closed_in", "open"


def changes_of(table: str) -> str:
    return f"{table}__changes"


def _opened(rows: DataFrame, version: str) -> DataFrame:
    return rows.withColumns({"valid_from": F.col(version), "valid_to": F.lit(None).cast(dict(rows.dtypes)[version]), CLOSED_IN: F.lit(OPEN)})


def merge_history(source: DataFrame, table: str, key: str, version: str, load: str) -> int:
    """Merge a load's rows, one for each key, into a history with validity; the number of rows that it changed.

    A row newer than the open version of its key closes that at its own version, and is open itself; an unknown key opens its first
    version; other rows change nothing. The open partition and the load's own closed one are written together, so that a
    load that comes again changes nothing more; closed partitions of other loads are neither read nor written. The changes are
    a partition of the table beside it: insert, update_preimage and update_postimage rows.
    """
    spark = source.sparkSession
    new = enforced(source, rules_of(spark, table)).persist(StorageLevel.DISK_ONLY)
    try:
        if new.isEmpty():
            return 0
        if not repeated_keys(new, [key]).isEmpty():
            raise ValueError(f"several rows of the source have one {key}")
        columns = new.columns
        if not spark.catalog.tableExists(table):
            changes = new.withColumn("_change", F.lit("insert")).withColumn("load", F.lit(load))
            replace_where(changes, changes_of(table), "load", load)
            return create_table(_opened(new, version), table, [CLOSED_IN])
        before = spark.table(table).where(F.col(CLOSED_IN) == OPEN)
        at = new.select(F.col(key), F.col(version).alias("_at"))
        met = before.join(at, key, "left").withColumn("_closes", F.coalesce(F.col(version) < F.col("_at"), F.lit(False))).persist(StorageLevel.DISK_ONLY)
        try:
            closed = met.where("_closes")
            postimage = new.join(closed.select(key), key, "left_semi")
            first = new.join(before.select(key), key, "left_anti")
            kind = lambda df, name: df.select(*columns, F.lit(name).alias("_change"), F.lit(load).alias("load"))
            changes = kind(first, "insert").unionByName(kind(closed, "update_preimage")).unionByName(kind(postimage, "update_postimage")).persist(StorageLevel.DISK_ONLY)
            n = changes.where("_change <> 'update_preimage'").count()
            if n:
                # The changes first: a run that breaks after them writes the same ones again. What a load did before stays.
                earlier = spark.table(changes_of(table)).where(F.col("load") == load)
                replace_where(changes.unionByName(earlier.select(*changes.columns)).distinct(), changes_of(table), "load", load)
                ended = closed.withColumn("valid_to", F.col("_at")).withColumn(CLOSED_IN, F.lit(load))
                own = [df.select(*spark.table(table).columns) for df in (ended, spark.table(table).where(F.col(CLOSED_IN) == load))]
                opened = _opened(postimage.unionByName(first), version).select(*own[0].columns)
                still = met.where(~F.col("_closes")).select(*own[0].columns)
                overwrite_partitions(still.unionByName(opened).unionByName(own[0].unionByName(own[1]).distinct()), table, {(OPEN,)})
            changes.unpersist()
            return n
        finally:
            met.unpersist()
    finally:
        new.unpersist()
