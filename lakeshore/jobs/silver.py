"""Jobs of the conformed layer. Days are yyyyMMdd, but yyyy-MM-dd for events."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import month_before
from ..plans import silver
from ..sources.sinks import merge_table, overwrite_table
from ..sources.tables import read_table
from ..streaming.ledger import read_due
from .run import written

#: Key and partitions of each dimension.
DIMENSIONS = {"customers": ("customer_id", ["source"]), "products": ("product_id", ["sales_unit"]), "branches": ("branch_id", ["region"]), "category": ("category_id", None)}
FEW_MONTHS = 24
TRANSACTION_KEYS, TRANSACTION_PARTITIONS = ["trans_id", "branch_id", "ym", "ymd"], ["branch_id", "ym", "ymd"]


def dimension(spark: SparkSession, name: str, day: str, raw: str = "bronze", database: str = "silver") -> int:
    """The day's newest rows of a dimension, merged by its key: matched rows are updated."""

    def clean(df: DataFrame) -> DataFrame:
        if name == "customers":
            return silver.clean_customers(df, day)
        if name == "products":
            return silver.enrich_products(df, read_table(spark, database, "category", missing_ok=True, schema="category_id string, category_name string"), day)
        return silver.clean_dimension(df, DIMENSIONS[name][0], silver.BRANCH_COLUMNS if name == "branches" else ["category_name"], day)

    key, partitions = DIMENSIONS[name]
    return written(read_table(spark, raw, name, {"report_date": day}), clean, lambda df: merge_table(df, f"{database}.{name}", [key], partitions, update=True))


def events(spark: SparkSession, bucket: str, day: str | list[str] | None, raw: str = "bronze", database: str = "silver") -> int:
    """A day's events of a bucket, those of several, or all for None, merged by event and day: those that are there already stay. An absent raw table has none."""
    if not spark.catalog.tableExists(f"{raw}.behavior_events"):
        return 0
    days = [day] if isinstance(day, str) else day
    source = read_table(spark, raw, "behavior_events")
    source = source if days is None else source.where(F.col("log_date").isin([datetime.date.fromisoformat(d) for d in days]))
    merge = lambda df: merge_table(df, f"{database}.events_{bucket}", ["event_uuid", "log_date"], ["log_date"], rules=silver.EVENT_RULES[bucket])
    return written(source, lambda df: silver.silver_events(df, bucket), merge)


def events_due(spark: SparkSession, bucket: str, raw: str = "bronze", database: str = "silver") -> int:
    """The events of all days that got raw rows since the last run, finished days too, by the ledger of the raw table."""
    return read_due(spark, f"{raw}.behavior_events", f"{database}.events_{bucket}", lambda days: events(spark, bucket, days, raw, database))


def nou(spark: SparkSession, day: str, raw: str = "bronze", database: str = "silver", buckets: int | None = None) -> int:
    """First days of the day's customers, merged into the registry: a late earlier order lowers one.

    A registry that is made with buckets, as many at least as shuffles have partitions, is never dealt anew when a day's orders are
    classified; each of its months then has a file for every bucket.
    """
    table = f"{database}.nou"

    def changed(batch: DataFrame) -> DataFrame:
        first = silver.first_orders(batch)
        if not spark.catalog.tableExists(table):
            return first
        there = spark.table(table).join(first.select("customer_id"), "customer_id", "left_semi")
        return silver.updated_registry(there, batch)

    source = read_table(spark, raw, "transactions", {"report_date": day}).where("customer_id is not null")
    return written(source, changed, lambda df: merge_table(df, table, ["customer_id"], ["ym"], update=True, buckets=buckets and (buckets, "customer_id")))


def transactions(spark: SparkSession, day: str, raw: str = "bronze", database: str = "silver", partitions: list[str] | None = None) -> int:
    """The day's orders, classified and merged by their keys; an order that is updated keeps its created_at. Run nou before."""
    table = f"{database}.transactions"

    def classified(batch: DataFrame) -> DataFrame:
        before = batch.select(month_before(F.date_format("transaction_datetime", "yyyyMM")).alias("ym")).distinct()
        months = [r[0] for r in before.limit(FEW_MONTHS + 1).collect()]
        prior = read_table(spark, database, "transactions", missing_ok=True, schema="customer_id string, ym string").where("customer_id is not null")
        # The months of a day's orders prune the scan; those of a first load of years are joined.
        prior = prior.where(F.col("ym").isin(months)) if len(months) <= FEW_MONTHS else prior.join(before, "ym", "left_semi")
        return silver.classify_transactions(batch, spark.table(f"{database}.nou"), prior)

    merge = lambda df: merge_table(df, table, TRANSACTION_KEYS, partitions or TRANSACTION_PARTITIONS, update=True, keep=("created_at",), rules=silver.TRANSACTION_RULES)
    return written(read_table(spark, raw, "transactions", {"report_date": day}), classified, merge)


def transactions_backfill(spark: SparkSession, raw: str = "bronze", database: str = "silver", buckets: int | None = None) -> int:
    """The registry and the orders of the whole history, written anew by month."""
    history = read_table(spark, raw, "transactions")
    written(history, silver.first_orders, lambda df: overwrite_table(df, f"{database}.nou", ["ym"], buckets and (buckets, "customer_id")))
    # The registry is read as it was written, not made again.
    classified = lambda df: silver.classify_history(df, spark.table(f"{database}.nou"))
    return written(history, classified, lambda df: overwrite_table(df, f"{database}.transactions", ["ym"]))
