"""Conformed layer: dimensions, events by bucket, first orders, classified transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..functions.vocabulary import BUCKETS, FIELDS, METADATA, NEW, RESURRECTED, RETAINED, STATUSES
from ..operators.rows import latest

EVENT_RULES = {b: {f"valid_event_id_{b}": f"event_id IN ({', '.join(map(str, ids))})"} for b, ids in BUCKETS.items()}
TRANSACTION_RULES = {
    "valid_order_status": "order_status IN ({})".format(", ".join(f"'{s}'" for s in STATUSES)),
    "valid_channel": "channel IN ('offline', 'online')",
    "valid_user_type": "user_type IN (1, 2, 3)",
}


def _newest(df: DataFrame, key: str) -> DataFrame:
    rest = sorted(c for c in df.columns if c not in (key, "updated_at"))
    return latest(df, [key], F.col("updated_at").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in rest])


def clean_customers(bronze: DataFrame, day: str) -> DataFrame:
    """The latest row of each customer: name joined, phone masked, gender and city read, and the kind of change on a day (yyyyMMdd)."""
    deleted = F.coalesce(F.col("is_deleted") == 1, F.lit(False))
    return _newest(bronze, "customer_id").select(
        "customer_id",
        clean.full_name(F.col("last_name"), F.col("first_name")).alias("full_name"),
        clean.masked(F.col("phone")).alias("phone"),
        "dob",
        "age",
        clean.gender(F.col("gender")).alias("gender"),
        clean.city(F.col("address_line")).alias("city"),
        clean.change_kind(deleted, F.col("created_at"), day).alias("_cdc_operation"),
        "registered_datetime",
        "updated_at",
        "source",
    )


def _retired() -> Column:
    return F.coalesce(~F.col("is_current"), F.lit(False))


def enrich_products(bronze: DataFrame, category: DataFrame, day: str) -> DataFrame:
    """The latest row of each product with its category's name (null if unknown). Spark broadcasts the categories if they are small."""
    named = _newest(bronze, "product_id").join(category.select("category_id", "category_name"), "category_id", "left")
    kind = clean.change_kind(_retired(), F.col("created_at"), day).alias("_cdc_operation")
    return named.select("product_id", "product_name", "product_display_name", "category_id", "category_name", "sales_unit", "color", "size", "unit_price", kind, "created_at", "updated_at")


def clean_dimension(bronze: DataFrame, key: str, columns: list[str], day: str) -> DataFrame:
    """The latest row of each key with the given columns, the kind of change and the times; for branches and categories."""
    kind = clean.change_kind(_retired(), F.col("created_at"), day).alias("_cdc_operation")
    return _newest(bronze, key).select(key, *columns, kind, "created_at", "updated_at")


BRANCH_COLUMNS = ["branch_name", "branch_type", "region", "city_province", "ward", "status", "open_date"]


def _valid_once(bronze: DataFrame, ids: list[int], day: str | None) -> DataFrame:
    """Valid events of the given types, once each (the version that came in last), with their time.

    Events without an id or time are dropped before the duplicates are sought, so that null ids don't meet in one
    group. `day` (yyyy-MM-dd) reads one partition.
    """
    own = bronze.where(F.col("event_id").isin(ids) & F.col("event_uuid").isNotNull() & (F.col("event_ts") > 0))
    own = own if day is None else own.where(F.col("log_date") == F.lit(day).cast("date"))
    once = latest(own, ["event_uuid"], F.col("_ingested_at").desc(), F.col("_kafka_partition").desc(), F.col("_kafka_offset").desc())
    return once.withColumn("event_time", F.expr("try_to_timestamp(created_at)").cast("timestamp_ntz"))


_EVERY = ["event_type", "event_time", "log_date", "session_id", "user_id", "device_os", "app_version"]


def silver_events(bronze: DataFrame, bucket: str, day: str | None = None) -> DataFrame:
    """Valid events of a bucket, once each, with the fields that the bucket's events fill. `day` (yyyy-MM-dd) reads one partition."""
    read = _valid_once(bronze, list(BUCKETS[bucket]), day).withColumn("meta", F.from_json("raw_metadata", METADATA))
    value = lambda c: (clean.keyword(F.col("meta.search_keyword")) if c == "search_keyword" else F.col(f"meta.{c}")).alias(c)
    key = clean.smart_key(F.date_format("event_time", "yyyyMMdd"), F.col("user_id"), F.col("event_id").cast("string"))
    extra = [F.col("meta.app_version").alias("meta_app_version")] if bucket == "discovery" else []
    return read.select("event_uuid", key.alias("trans_event_id"), "event_id", *_EVERY, *extra, *map(value, FIELDS[bucket]))


def every_event(bronze: DataFrame, day: str | None = None) -> DataFrame:
    """Valid events of all buckets in one pass, with what the hourly marts need: `failed` says whether a flag of the event says no."""
    ids = [i for bucket in BUCKETS.values() for i in bucket]
    read = _valid_once(bronze, ids, day).withColumn("meta", F.from_json("raw_metadata", "is_success int, is_valid int"))
    return read.select("event_uuid", *_EVERY, clean.failed(F.col("meta.is_success"), F.col("meta.is_valid")).alias("failed"))


def dedup_transactions(bronze: DataFrame) -> DataFrame:
    """The latest snapshot of each order in its branch, by updated_at, then load time."""
    return latest(bronze, ["transaction_id", "branch_id"], F.col("updated_at").desc_nulls_last(), F.col("_loaded_at").desc_nulls_last(), F.col("order_status"))


def with_times(transactions: DataFrame) -> DataFrame:
    """Add the order's amount, key and the parts of its time; a null customer shortens the key."""
    at = F.col("transaction_datetime")
    day, month = F.date_format(at, "yyyyMMdd"), F.date_format(at, "yyyyMM")
    parts = {"ymd": day, "ym": month, "trans_month": month, "trans_date": at.cast("date"), "trans_time": F.date_format(at, "HH:mm:ss"), "timestamp": clean.epoch_seconds(at)}
    key = clean.smart_key(day, F.col("customer_id"), F.col("transaction_id"))
    return transactions.withColumns(parts | {"trans_id": key, "order_total_amount": F.col("trans_total_amount")})


def first_orders(transactions: DataFrame) -> DataFrame:
    """(customer_id, nou_ymd, ym): the day and month of each customer's first order; orders without a customer are left out."""
    known = transactions.where("customer_id is not null")
    # The least time is kept as a number, where a least text would need the orders sorted.
    first = known.groupBy("customer_id").agg(F.date_format(F.min("transaction_datetime"), "yyyyMMdd").alias("nou_ymd"))
    return first.withColumn("ym", F.substring("nou_ymd", 1, 6))


def new_customers(history: DataFrame, day: str, registry: DataFrame) -> DataFrame:
    """First orders of the customers of a day (yyyyMMdd) that the registry lacks, over their whole history."""
    today = history.where((F.date_format("transaction_datetime", "yyyyMMdd") == day) & F.col("customer_id").isNotNull())
    new = today.select("customer_id").distinct().join(registry.select("customer_id"), "customer_id", "left_anti")
    return first_orders(history.join(new, "customer_id", "left_semi"))


def updated_registry(registry: DataFrame, batch: DataFrame) -> DataFrame:
    """The registry with a batch's first orders; an earlier order that came late lowers a customer's day, as a rebuild would."""
    both = registry.select("customer_id", "nou_ymd").unionByName(first_orders(batch).select("customer_id", "nou_ymd"))
    return both.groupBy("customer_id").agg(F.min("nou_ymd").alias("nou_ymd")).withColumn("ym", F.substring("nou_ymd", 1, 6))


_SILVER = ["trans_month", "trans_date", "trans_time", "timestamp", "trans_id", "customer_id", "user_type", "NOU", "nou_ymd", "branch_id", "channel", "order_status", "payment_type", "order_total_amount", "created_at", "updated_at", "ym", "ymd"]


def classify_transactions(batch: DataFrame, registry: DataFrame, prior: DataFrame) -> DataFrame:
    """Deduplicated orders with the customer's type in the order's month, and NOU, 1 for the customer's very first order.

    registry has first orders, the batch's own included; prior has (customer_id, ym) of months before, where the batch
    itself counts too. A customer is new in the month of the first order, retained after a month with an order,
    resurrected otherwise; an order without a customer has no type.
    """
    # An order without a customer joins by a key of its own that nothing has, so that such orders don't meet in one task.
    who = F.coalesce("customer_id", F.concat(F.lit("\0"), "transaction_id")).alias("_who")
    once, at = dedup_transactions(batch).select("*", who), F.col("transaction_datetime")
    order = lambda seconds: F.struct(seconds.alias("timestamp"), "transaction_id", F.coalesce("branch_id", F.lit("")).alias("b"))
    # One row for each customer of the batch: the months with orders, the first order in the batch, and the first day ever. So
    # whole orders are joined once, by customer, and their texts are made after that.
    known = once.where("customer_id is not null").select("customer_id", (F.year(at) * 12 + F.month(at)).alias("_month"), order(clean.epoch_seconds(at)).alias("_order"))
    before = prior.select("customer_id", clean.month_number(F.col("ym")).alias("_month"), F.lit(None).cast(known.schema["_order"].dataType).alias("_order"))
    each = before.unionByName(known).groupBy("customer_id").agg(F.min("_order").alias("_earliest"), F.collect_set("_month").alias("_months"))
    first = each.join(registry.select("customer_id", "nou_ymd", F.col("ym").alias("_first_ym")), "customer_id", "left").withColumnRenamed("customer_id", "_who")
    joined = with_times(once.join(first, "_who", "left"))
    kind = F.when(F.col("customer_id").isNull(), F.lit(None)).when(F.col("_first_ym").isNull() | (F.col("_first_ym") == F.col("ym")), NEW)
    kind = kind.when(F.array_contains("_months", F.year(at) * 12 + F.month(at) - 1), RETAINED).otherwise(RESURRECTED)
    is_first = F.coalesce((F.col("ymd") == F.col("nou_ymd")) & (order(F.col("timestamp")) == F.col("_earliest")), F.lit(False))
    return joined.withColumn("NOU", is_first.cast("int")).withColumn("user_type", kind.cast("int")).select(*_SILVER)


def classify_history(history: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """classify_transactions over a whole history."""
    prior = history.sparkSession.createDataFrame([], "customer_id string, ym string")
    return classify_transactions(history, first_orders(history) if registry is None else registry, prior)


def user_types(silver: DataFrame) -> DataFrame:
    return silver.groupBy("user_type").agg(F.count("*").alias("n_orders"))
