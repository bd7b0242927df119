"""Jobs of the dashboard layer: a day is replaced as a whole, so that a second run changes nothing. Days are yyyy-MM-dd."""

from __future__ import annotations

import datetime

from pyspark import StorageLevel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..plans import gold
from ..sources.sinks import replace_where
from ..sources.tables import read_table
from .run import written

PARTITIONS = ["branch_id", "ym", "ymd"]


def events(spark: SparkSession, bucket: str, day: str | list[str], source: str = "silver", database: str = "gold") -> int:
    """A day's events, or those of several, counted at the bucket's grain. An absent source has none, and its day stays as it is."""
    if not spark.catalog.tableExists(f"{source}.events_{bucket}"):
        return 0
    on = [datetime.date.fromisoformat(d) for d in ([day] if isinstance(day, str) else day)]
    rows = read_table(spark, source, f"events_{bucket}").where(F.col("log_date").isin(on))
    return written(rows, lambda df: gold.gold_events(df, bucket), lambda df: replace_where(df, f"{database}.events_{bucket}", "log_date", on, ["log_date"]))


def sales(spark: SparkSession, day: str, source: str = "silver", database: str = "gold") -> int:
    """Customers' sales and the ages of orders on a day, both from one snapshot. The number of rows of both."""
    snapshot = gold.prepare_snapshot(read_table(spark, source, "transactions"), day).select(*gold.MART_COLUMNS).persist(StorageLevel.DISK_ONLY)
    ymd, marts = day.replace("-", ""), {"daily_customer_sales": gold.daily_customer_sales, "daily_logistics_aging": gold.daily_logistics_aging}
    try:
        return sum(written(snapshot, build, lambda df, name=name: replace_where(df, f"{database}.{name}", "ymd", ymd, PARTITIONS)) for name, build in marts.items())
    finally:
        snapshot.unpersist()
