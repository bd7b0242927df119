"""Dashboard layer: event counts, customer sales, order aging and hourly marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..functions.vocabulary import STOCK

_EVENT = ["event_type", "log_date", "session_id", "user_id"]
EVENT_GRAIN = {
    "discovery": [*_EVENT, "source_screen", "source_element", "position", "search_keyword", "product_id"],
    "cart": [*_EVENT, "source_screen", "source_element", "product_id"],
    "checkout": [*_EVENT, "payment_method", "shipping_method", "promotion_id", "is_success", "error_code", "error_message"],
}


def gold_events(silver: DataFrame, bucket: str) -> DataFrame:
    """Events counted at the bucket's grain, null values being values; for carts also the units put in and taken out."""
    measures = [F.count("event_uuid").alias("event_count")]
    if bucket == "cart":
        units = lambda kind, value: F.sum(F.when(F.col("event_type") == kind, F.col(value)).otherwise(0))
        measures += [units("add_to_cart", "quantity").alias("qty_added"), units("remove_from_cart", "removed_quantity").alias("qty_removed")]
    return silver.groupBy(*EVENT_GRAIN[bucket]).agg(*measures)


def prepare_snapshot(transactions: DataFrame, snapshot: str) -> DataFrame:
    """Orders in hand on a day (yyyy-MM-dd), with those closed on it; their age in days, and its category.

    One pass: the age runs to the snapshot for orders in hand, to the closing day for others. Orders that came after
    the snapshot are left out, and so are those with failed payment or no status.
    """
    day, status = F.lit(snapshot).cast("date"), F.col("order_status")
    closed = F.col("updated_at").cast("date")
    kept = transactions.where((clean.in_stock(status) & (F.col("trans_date") <= day)) | (clean.in_flow(status) & (closed == day)))
    age = F.datediff(F.when(clean.in_stock(status), day).otherwise(closed), "trans_date")
    return kept.select(
        *[c for c in transactions.columns if c not in ("ym", "ymd")],
        age.alias("diff_date"),
        clean.aging(age).alias("aging_category"),
        day.alias("snapshot_date"),
        F.date_format(day, "yyyyMM").alias("ym"),
        F.date_format(day, "yyyyMMdd").alias("ymd"),
    )


#: What both marts read of a snapshot.
MART_COLUMNS = ["snapshot_date", "trans_id", "customer_id", "user_type", "branch_id", "channel", "payment_type", "order_status", "aging_category", "order_total_amount"]


def _with_parts(mart: DataFrame) -> DataFrame:
    """A mart with the month and day of its snapshot, which needn't be grouped by."""
    return mart.withColumns({"ym": F.date_format("snapshot_date", "yyyyMM"), "ymd": F.date_format("snapshot_date", "yyyyMMdd")})


_GROUPS = {"processing": STOCK, "recognized": ("I",), "returned": ("B",), "cancelled": ("C", "R")}


def daily_customer_sales(prepared: DataFrame) -> DataFrame:
    """Revenue and distinct orders by customer and status group.

    Orders are first reduced to one row each with its groups' revenue, so that the distinct counts are plain sums and no row
    is expanded once for every count.
    """
    keys = ["snapshot_date", "customer_id", "branch_id", "user_type", "channel", "payment_type"]
    of = lambda codes: F.col("order_status").isin(*codes)
    each = [F.sum(F.when(of(c), F.col("order_total_amount")).otherwise(0)).alias(f"{n}_rev") for n, c in _GROUPS.items()]
    seen = [F.max(F.when(of(c) & F.col("trans_id").isNotNull(), 1).otherwise(0)).alias(f"{n}_orders") for n, c in _GROUPS.items()]
    orders = prepared.groupBy(*keys, "trans_id").agg(*each, *seen)
    totals = [F.sum(f"{n}_rev").alias(f"{n}_rev") for n in _GROUPS] + [F.sum(f"{n}_orders").cast("int").alias(f"{n}_orders") for n in _GROUPS]
    return _with_parts(orders.groupBy(*keys).agg(*totals)).select(*keys, "ym", "ymd", *[f"{n}_{x}" for x in ("rev", "orders") for n in _GROUPS])


def daily_logistics_aging(prepared: DataFrame) -> DataFrame:
    """Revenue and distinct orders by age and status."""
    keys = ["snapshot_date", "aging_category", "branch_id", "order_status", "channel", "payment_type"]
    mart = prepared.groupBy(*keys).agg(F.sum("order_total_amount").alias("total_rev"), F.countDistinct("trans_id").cast("int").alias("total_orders"))
    return _with_parts(mart).select(*keys, "ym", "ymd", "total_rev", "total_orders")


def _hour():
    return F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("hour")


def funnel_hourly(events: DataFrame) -> DataFrame:
    """By hour, version, system and type: events, those that didn't fail, distinct users."""
    return events.groupBy(_hour(), "app_version", "device_os", "event_type").agg(
        F.count("*").alias("event_count"), F.sum(F.when(F.col("failed"), 0).otherwise(1)).alias("success_count"), F.countDistinct("user_id").alias("unique_users")
    )


def app_health_hourly(events: DataFrame) -> DataFrame:
    """By hour, version and type: events and failures."""
    return events.groupBy(_hour(), "app_version", "event_type").agg(F.count("*").alias("total_count"), F.sum(F.when(F.col("failed"), 1).otherwise(0)).alias("error_count"))


def user_activity_daily(events: DataFrame) -> DataFrame:
    """By day and user: events, sessions, first and last time."""
    return events.groupBy("log_date", "user_id").agg(
        F.count("*").alias("event_count"), F.countDistinct("session_id").alias("session_count"), F.min("event_time").alias("first_event_at"), F.max("event_time").alias("last_event_at")
    )


def item_revenue_hourly(lines: DataFrame) -> DataFrame:
    """By hour and item: units, revenue, distinct buyers. lines: event_time, item, units, revenue, buyer."""
    return lines.groupBy(_hour(), "item").agg(F.sum("units").alias("units_sold"), F.sum("revenue").alias("total_revenue"), F.countDistinct("buyer").alias("unique_buyers"))


def exact_users(events: DataFrame, *keys: str) -> DataFrame:
    """Distinct users by the given keys; sums of hourly counts would count a user once for every hour."""
    return events.groupBy(*keys).agg(F.countDistinct("user_id").alias("unique_users"))
