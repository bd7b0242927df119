"""Loads of the raw layer: what changed in the ERP tables on a day, stamped and appended."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import bronze
from ..sources.sinks import append_table, merge_table
from .run import written

#: Reads the rows of an ERP table that changed on a day (yyyy-MM-dd), as sources.tables.read_jdbc_incremental does.
Erp = Callable[[str, str], DataFrame]
#: The times that a dimension's load day comes from, in order, and its partitions.
DIMENSIONS = {
    "customers": (("updated_at", "created_at", "registered_datetime"), ["report_date"]),
    "products": (("updated_at", "created_at"), ["report_date"]),
    "branches": (("updated_at", "created_at"), ["report_date"]),
    "category": (("updated_at", "created_at"), None),
}


def load_dimension(erp: Erp, name: str, day: str, database: str = "bronze") -> int:
    times, partitions = DIMENSIONS[name]
    return written(erp(name, day), lambda df: bronze.stamp_load(df, *times), lambda df: append_table(df, f"{database}.{name}", partitions))


#: Reads the rows of a source that changed at a time or later, all for None, as sources.tables.read_jdbc does with since_condition.
Changes = Callable[[datetime.datetime | None], DataFrame]
#: Changes may be committed so much later than they are stamped.
OVERLAP = datetime.timedelta(hours=1)


def marks_of(database: str) -> str:
    return f"{database}.high_water"


def high_water(spark: SparkSession, source: str, database: str = "bronze") -> datetime.datetime | None:
    """The last change time of a source that has been loaded."""
    if not spark.catalog.tableExists(marks_of(database)):
        return None
    row = spark.table(marks_of(database)).where(F.col("source") == source).first()
    return row and row["changed_at"]


def load_changes(spark: SparkSession, read: Changes, name: str, key: str, database: str = "bronze", overlap: datetime.timedelta = OVERLAP) -> int:
    """Load what has changed in a source since its high-water mark, whatever days that covers. The number of rows that are new.

    The read begins `overlap` before the mark, for changes that were committed late; a version of a row (its key and change time) that
    is there already doesn't come again. So a run that broke before it moved the mark can be repeated. Rows without any
    change time come with the first load only.
    """
    times, partitions = DIMENSIONS[name]
    mark = high_water(spark, name, database)
    since = mark - overlap if mark else None
    changed = F.coalesce(*[F.col(t).cast("timestamp_ntz") for t in times]).alias("_changed")
    rows = read(since).select("*", changed)
    target = f"{database}.{name}"
    if since and spark.catalog.tableExists(target):
        there = spark.table(target)
        there = there.where(F.col("report_date") >= f"{since:%Y%m%d}") if partitions else there  # prunes
        rows = rows.join(there.select(key, changed).distinct().withColumn("_loaded", F.lit(True)), [key, "_changed"], "left")
    else:
        rows = rows.withColumn("_loaded", F.lit(None).cast("boolean"))
    rows = rows.persist(StorageLevel.DISK_ONLY)
    try:
        last = rows.agg(F.max("_changed")).first()[0]
        new = rows.where("_loaded is null").drop("_changed", "_loaded")
        n = append_table(bronze.stamp_load(new, *times), target, partitions)
        if last and (mark is None or last > mark):
            row = spark.createDataFrame([(name, last)], "source string, changed_at timestamp_ntz")
            merge_table(row, marks_of(database), ["source"], update=True)
        return n
    finally:
        rows.unpersist()


def load_transactions(erp: Erp, day: str, database: str = "bronze", partitions: tuple[str, ...] = ("report_date",)) -> int:
    """The day's order headers of both channels. A first load of years may make the table with other partitions."""
    both = bronze.unify_transactions(erp("pos_transactions", day), erp("online_transactions", day))
    return written(both, lambda df: df, lambda df: append_table(df, f"{database}.transactions", list(partitions)))


def load_transaction_details(erp: Erp, day: str, database: str = "bronze", partitions: tuple[str, ...] = ("report_date",)) -> int:
    """The day's order lines of both channels, rolled up by order."""
    rolled = bronze.rollup_details(erp("pos_transaction_details", day), erp("online_transaction_details", day))
    return written(rolled, lambda df: df, lambda df: append_table(df, f"{database}.transaction_details", list(partitions)))
