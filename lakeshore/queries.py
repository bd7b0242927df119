"""The registered queries of the library: each runs operators on the star-schema tables in the retailer's shape."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conform
from .jobs import bronze as bronze_jobs
from .jobs import gold as gold_jobs
from .jobs import history
from .jobs import publish as publish_jobs
from .jobs import silver as silver_jobs
from .operators import layout, quality, upsert
from .operators.rows import latest
from .plans import bronze, gold, reports, silver, users
from .sources import sinks
from .sources.shared import checkpointed, dropped, fresh_path
from .streaming import events as stream
from .streaming import ledger

AS_OF, SNAPSHOT, DAY = "2024-01-20", "1998-06-15", "20240105"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _raw_events(spark: SparkSession, sf: str) -> DataFrame:
    return stream.parse_events(conform.event_records(spark, sf), F.col("timestamp"))


def _silver_events(spark: SparkSession, sf: str, bucket: str) -> DataFrame:
    return silver.silver_events(_raw_events(spark, sf), bucket)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return silver.every_event(_raw_events(spark, sf))


def _transactions(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.unify_transactions(*conform.orders(spark, sf))


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return silver.classify_history(_transactions(spark, sf))


@query
def bronze_events(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_events(spark, sf).drop("raw_metadata", "_ingested_at")


@query
def bronze_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _transactions(spark, sf).drop("_loaded_at")


@query
def bronze_transaction_details(spark: SparkSession, sf: str) -> DataFrame:
    return _lines_as_text(bronze.rollup_details(*conform.order_lines(spark, sf)))


def _lines_as_text(rolled: DataFrame) -> DataFrame:
    fields = ["transaction_detail_id", "product_id", "is_promo", "product_uom_code", "trans_qty", "trans_line_amount", "variant_size", "variant_color"]
    text = F.array_join(F.transform("trans_metadata", lambda x: F.concat_ws(":", *[F.coalesce(x[f].cast("string"), F.lit("-")) for f in fields])), ",")
    return rolled.withColumn("trans_metadata", text)


@query
def silver_events_discovery(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_events(spark, sf, "discovery")


@query
def silver_events_cart(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_events(spark, sf, "cart")


@query
def silver_events_checkout(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_events(spark, sf, "checkout").withColumn("items_list", F.array_join("items_list", ","))


@query
def silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_customers(conform.customers(spark, sf), DAY)


@query
def silver_products(spark: SparkSession, sf: str) -> DataFrame:
    return silver.enrich_products(conform.products(spark, sf), conform.categories(spark, sf), DAY)


@query
def silver_branches(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_dimension(conform.branches(spark, sf), "branch_id", silver.BRANCH_COLUMNS, DAY)


@query
def silver_category(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_dimension(conform.categories(spark, sf), "category_id", ["category_name"], DAY)


@query
def silver_nou(spark: SparkSession, sf: str) -> DataFrame:
    return silver.first_orders(_transactions(spark, sf))


@query
def silver_nou_daily(spark: SparkSession, sf: str) -> DataFrame:
    """New customers of one day, against a registry of the days before."""
    history = _transactions(spark, sf)
    before = silver.first_orders(history.where("transaction_datetime < timestamp_ntz'1996-03-01'"))
    return silver.new_customers(history, "19960301", before)


@query
def silver_nou_updated(spark: SparkSession, sf: str) -> DataFrame:
    """A registry of online orders, updated with the POS orders, some of which are earlier."""
    history = _transactions(spark, sf)
    registry = silver.first_orders(history.where("channel = 'online'"))
    return silver.updated_registry(registry, history.where("channel = 'offline'"))


@query
def silver_transactions_latest(spark: SparkSession, sf: str) -> DataFrame:
    return silver.dedup_transactions(_transactions(spark, sf)).select("transaction_id", "branch_id", "channel", "order_status", "updated_at")


@query
def silver_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf)


@query
def user_type_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return silver.user_types(_classified(spark, sf))


@query
def gold_events_discovery(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_events(_silver_events(spark, sf, "discovery"), "discovery")


@query
def gold_events_cart(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_events(_silver_events(spark, sf, "cart"), "cart")


@query
def gold_events_checkout(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_events(_silver_events(spark, sf, "checkout"), "checkout")


@query
def gold_daily_customer_sales(spark: SparkSession, sf: str) -> DataFrame:
    return gold.daily_customer_sales(gold.prepare_snapshot(_classified(spark, sf), SNAPSHOT))


@query
def gold_daily_logistics_aging(spark: SparkSession, sf: str) -> DataFrame:
    return gold.daily_logistics_aging(gold.prepare_snapshot(_classified(spark, sf), SNAPSHOT))


@query
def gold_funnel_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return gold.funnel_hourly(_events(spark, sf))


@query
def gold_app_health_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return gold.app_health_hourly(_events(spark, sf))


@query
def gold_user_activity_daily(spark: SparkSession, sf: str) -> DataFrame:
    return gold.user_activity_daily(_events(spark, sf))


@query
def gold_item_revenue_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return gold.item_revenue_hourly(conform.sale_lines(spark, sf))


@query
def exact_users_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return gold.exact_users(_events(spark, sf), "log_date", "event_type")


def _users_mart(spark: SparkSession, sf: str) -> DataFrame:
    # Made once: the numbers and the mart both read them.
    events = checkpointed(_events(spark, sf).select("event_time", *users.GRAIN, "user_id"))
    return users.users_hourly(events, users.numbered_users(events))


@query
def report_users_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct users of each day, merged from the bitmaps of its hours."""
    mart = _users_mart(spark, sf).withColumn("log_date", F.col("hour").cast("date"))
    return users.distinct_users(mart, "log_date", "event_type")


@query
def report_users_by_system(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct users of a week by system and type: each once, where sums over hours count a user for every hour."""
    week = _users_mart(spark, sf).where(f"hour >= TIMESTAMP_NTZ'{AS_OF} 00:00:00' - INTERVAL 7 DAY")
    return users.distinct_users(week, "device_os", "event_type")


@query
def report_buyers_by_item(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct buyers of each item in a week, merged from the bitmaps of its hours."""
    lines = conform.sale_lines(spark, sf).withColumnRenamed("buyer", "user_id")
    mart = users.users_hourly(lines, users.numbered_users(lines), ["item"])
    return users.distinct_users(mart.where(f"hour >= TIMESTAMP_NTZ'{AS_OF} 00:00:00' - INTERVAL 7 DAY"), "item")


_MARTS: dict[str, Query] = {"app_health": gold_app_health_hourly, "funnel": gold_funnel_hourly, "revenue": gold_item_revenue_hourly}


def _report(name: str) -> Query:
    mart = next(m for m in _MARTS if f"{{{m}}}" in reports.REPORTS[name])
    return lambda spark, sf: reports.run_report(spark, name, AS_OF, **{mart: _MARTS[mart](spark, sf)})


QUERIES |= {f"report_{name}": _report(name) for name in reports.REPORTS}

_KEY = ["transaction_id", "branch_id"]


def _two_states(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders made before 1998, and later versions of those made since June 1997: each order is in one of the states, or in both."""
    all_ = silver.dedup_transactions(_transactions(spark, sf)).select(*_KEY, "order_status", "created_at", "updated_at")
    later = all_.where("created_at >= timestamp_ntz'1997-06-01'").withColumn("order_status", F.lit("I"))
    later = later.withColumns({"created_at": F.timestamp_add("DAY", F.lit(1), "created_at"), "updated_at": F.timestamp_add("DAY", F.lit(50), "updated_at")})
    return all_.where("created_at < timestamp_ntz'1998-01-01'"), later


@query
def upsert_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.upsert(*_two_states(spark, sf), _KEY)


@query
def upsert_update(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.upsert(*_two_states(spark, sf), _KEY, update=True)


@query
def upsert_keep_created(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.upsert(*_two_states(spark, sf), _KEY, update=True, keep=("created_at",))


@query
def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _two_states(spark, sf)
    return upsert.change_feed(old, new, _KEY)


@query
def scd2_customers(spark: SparkSession, sf: str) -> DataFrame:
    """History of the customers who registered before 2024-01-07, merged with the latest rows of all."""
    rows = silver.clean_customers(conform.customers(spark, sf), DAY).select("customer_id", "full_name", "registered_datetime", "updated_at")
    n = F.substring("customer_id", 2, 20).cast("long")
    before = F.timestamp_add("DAY", F.when(n % 2 == 0, F.lit(-9)).otherwise(F.lit(0)), "updated_at")
    target = rows.where("registered_datetime < timestamp_ntz'2024-01-07'").withColumns({"full_name": F.upper("full_name"), "updated_at": before})
    target = target.withColumns({"is_current": F.lit(True), "valid_from": F.col("updated_at"), "valid_to": F.lit(None).cast("timestamp_ntz")})
    return upsert.scd2_merge(target.drop("registered_datetime"), rows.drop("registered_datetime"), "customer_id")


_RULES = silver.TRANSACTION_RULES | {"paid": "order_status <> 'F'", "small": "order_total_amount < 200000", "has_customer": "customer_id IS NOT NULL"}


@query
def constraint_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.violations(_classified(spark, sf), _RULES)


@query
def quarantined_transactions(spark: SparkSession, sf: str) -> DataFrame:
    bad = quality.quarantine(_classified(spark, sf), _RULES)[1]
    return bad.select("trans_id", "branch_id", F.array_join("_broken", ",").alias("broken"))


#: Bytes of a file after compaction.
FILE_BYTES = 128 << 20


def _bytes(df: DataFrame) -> int:
    """The size of the files that a frame is read from."""
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    return files.agg(F.sum("size")).first()[0] or 0


@query
def compacted_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = conform.table(spark, sf, "orders")
    return layout.compact(orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), _bytes(orders), FILE_BYTES, ["o_orderstatus"])


@query
def zordered_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = conform.table(spark, sf, "orders")
    return layout.zorder(orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey", "o_totalprice"], -(-_bytes(orders) // FILE_BYTES))


def _sale_records(spark: SparkSession, sf: str) -> DataFrame:
    """`events` as records of a sale topic."""
    n = F.col("event_id")
    units = F.when(n % 7 != 0, F.transform(F.sequence(F.lit(1), (1 + n % 3).cast("int")), lambda k: F.concat(F.lit("A"), k)))
    metadata = F.struct(
        F.when(n % 11 != 0, F.concat(F.lit("item "), n % 50)).alias("item"), F.when(n % 4 == 0, 0).otherwise(1).alias("is_success"),
        units.alias("units"), F.when(n % 2 == 0, "no funds").alias("error_message"),
    )
    kind = F.when(F.col("event_type") == "purchase", "item_sold").when(F.col("event_type") == "error", "payment_failed").when(F.col("event_type") == "view", "view_item").otherwise("other")
    envelope = F.struct(kind.alias("event_type"), F.concat(F.lit("u"), F.col("user_id")).alias("user_id"), metadata.alias("metadata"))
    return conform.table(spark, sf, "events").select("event_id", "ts", F.to_json(envelope).cast("binary").alias("value"))


def _sales(spark: SparkSession, sf: str) -> DataFrame:
    return stream.parse_sales(_sale_records(spark, sf))


@query
def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return stream.route_alerts(_sales(spark, sf))


@query
def stream_running_sales(spark: SparkSession, sf: str) -> DataFrame:
    return stream.running_sales(_sales(spark, sf), 150000)


@contextmanager
def _databases(spark: SparkSession, *names: str) -> Iterator[list[str]]:
    """New databases for the jobs of one query, under names that no earlier session has left files of; dropped at the end."""
    made = [f"lakeshore_{name}_{uuid4().hex[:12]}" for name in names]
    for name in made:
        spark.sql(f"CREATE DATABASE {name}")
    try:
        yield made
    finally:
        for name in made:
            spark.sql(f"DROP DATABASE {name} CASCADE")


@contextmanager
def _folders(spark: SparkSession, *names: str) -> Iterator[list[str]]:
    """New shared folders for one query, deleted at the end."""
    made = [fresh_path(spark, name) for name in names]
    try:
        yield made
    finally:
        for path in made:
            dropped(spark, path)


def _delivered(spark: SparkSession, records: DataFrame, first: Column, path: str, run: Callable[[], None]) -> None:
    """Write records to a folder in two deliveries, `first` and the others, and run what reads the folder after each."""
    for part in (first, ~first):
        records.where(part).write.mode("append").parquet(path)
        run()


@query
def job_bronze_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers loaded on two days: what changed until 2024-01-05, what has since, and nothing on a third day."""
    rows = conform.customers(spark, sf)
    changed = {"1": rows.where("updated_at < timestamp_ntz'2024-01-05'"), "2": rows.where("updated_at >= timestamp_ntz'2024-01-05'"), "3": rows.limit(0)}
    with _databases(spark, "bronze") as (db,):
        for day in changed:
            bronze_jobs.load_dimension(lambda _, d: changed[d], "customers", day, db)
        return checkpointed(spark.table(f"{db}.customers").drop("_loaded_at"))


@query
def job_bronze_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers loaded by their high-water mark: a run sees what has changed so far, the next one what has since, with two days of overlap;
    a third finds nothing new."""
    rows = conform.customers(spark, sf)
    source = [rows.where("updated_at < timestamp_ntz'2024-01-05'"), rows, rows]
    with _databases(spark, "changes") as (db,):
        for there in source:
            bronze_jobs.load_changes(spark, lambda since: there if since is None else there.where(F.col("updated_at") >= F.lit(since)), "customers", "customer_id", db, datetime.timedelta(days=2))
        return checkpointed(spark.table(f"{db}.customers").drop("_loaded_at"))


def _history(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """A history of customers after two days' loads, the second of which comes twice; or its changes."""
    rows = conform.customers(spark, sf).select("customer_id", "first_name", "updated_at")
    days = {"20240104": rows.where("updated_at < timestamp_ntz'2024-01-05'"), "20240105": rows.where("updated_at >= timestamp_ntz'2024-01-05'")}
    with _databases(spark, "history") as (db,):
        for day in ("20240104", "20240105", "20240105"):
            newest = latest(days[day], ["customer_id"], F.col("updated_at").desc(), F.col("first_name"))
            history.merge_history(newest, f"{db}.customers", "customer_id", "updated_at", day)
        return checkpointed(spark.table(f"{db}.{table}"))


@query
def job_history_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf, "customers")


@query
def job_history_changes(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf, history.changes_of("customers"))


@query
def job_bronze_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Both channels' order headers of years, loaded in two runs."""
    pos, online = conform.orders(spark, sf)
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    own = lambda day: F.col("updated_at") < cut if day == "1" else F.col("updated_at") >= cut
    with _databases(spark, "headers") as (db,):
        for day in ("1", "2"):
            bronze_jobs.load_transactions(lambda name, d: (pos if name.startswith("pos") else online).where(own(d)), day, db, ("report_month",))
        return checkpointed(spark.table(f"{db}.transactions").drop("_loaded_at"))


@query
def job_bronze_transaction_details(spark: SparkSession, sf: str) -> DataFrame:
    """Both channels' order lines of years, rolled up and loaded at once."""
    pos, online = conform.order_lines(spark, sf)
    with _databases(spark, "lines") as (db,):
        bronze_jobs.load_transaction_details(lambda name, _: pos if name.startswith("pos") else online, "1", db, ("channel",))
        return checkpointed(_lines_as_text(spark.table(f"{db}.transaction_details").drop("_loaded_at")))


@query
def job_silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers conformed over two loads: the second brings newer versions of some. Both are merged by customer."""
    rows = conform.customers(spark, sf)
    with _databases(spark, "raw_customers", "customers") as (raw, db):
        for load, part in (("20240104", "updated_at < timestamp_ntz'2024-01-05'"), ("20240105", "updated_at >= timestamp_ntz'2024-01-05'")):
            sinks.append_table(rows.where(part).withColumn("report_date", F.lit(load)), f"{raw}.customers", ["report_date"])
            silver_jobs.dimension(spark, "customers", load, raw, db)
        return checkpointed(spark.table(f"{db}.customers").drop("_cdc_operation"))


@query
def job_silver_events_cart(spark: SparkSession, sf: str) -> DataFrame:
    """Raw events appended twice, as at-least-once delivery may; the whole table merged, then one day again."""
    with _databases(spark, "cart") as (db,):
        delivered = checkpointed(_raw_events(spark, sf))
        for _ in range(2):
            sinks.append_table(delivered, f"{db}.behavior_events", ["log_date"])
        for day in (None, "2024-01-05"):
            silver_jobs.events(spark, "cart", day, db, db)
        return checkpointed(spark.table(f"{db}.events_cart"))


@query
def job_silver_late_events(spark: SparkSession, sf: str) -> DataFrame:
    """Raw events in two batches of a stream, the second from partitions of the topic that were down, with events of all days. The job
    runs after each on the days that the ledger tells; a batch that comes again changes nothing."""
    records = conform.event_records(spark, sf)
    with _databases(spark, "late") as (db,):
        write = stream.write_bronze_batch(f"{db}.behavior_events", query="topic", ingested_at=F.col("timestamp"))
        for epoch, part in ((0, "partition < 7"), (1, "partition >= 7"), (1, "partition >= 7")):
            write(records.where(part), epoch)
            silver_jobs.events_due(spark, "cart", db, db)
        return checkpointed(spark.table(f"{db}.events_cart"))


@query
def job_silver_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in two loads, changed before 1998 and since; the second brings changed statuses and late orders. A third load is empty."""
    load = F.when(F.col("updated_at") < F.lit("1998-01-01").cast("timestamp_ntz"), "19971231").otherwise("19980101")
    with _databases(spark, "orders", "classified") as (db, out):
        sinks.append_table(_transactions(spark, sf).withColumn("report_date", load), f"{db}.transactions", ["report_date"])
        for day in ("19971231", "19980101", "19980102"):
            silver_jobs.nou(spark, day, db, out)
            silver_jobs.transactions(spark, day, db, out, ["ym"])
        return checkpointed(spark.table(f"{out}.transactions").select(_classified(spark, sf).columns))


@query
def job_gold_events_cart(spark: SparkSession, sf: str) -> DataFrame:
    """Every day's cart events counted by the daily job, the first day twice."""
    with _databases(spark, "carts", "cart_marts") as (db, out):
        sinks.append_table(_silver_events(spark, sf, "cart"), f"{db}.events_cart", ["log_date"])
        days = [str(r[0]) for r in spark.table(f"{db}.events_cart").select("log_date").distinct().orderBy("log_date").collect()]
        for some in (days, days[0]):
            gold_jobs.events(spark, "cart", some, db, out)
        return checkpointed(spark.table(f"{out}.events_cart").select(*gold.EVENT_GRAIN["cart"], "event_count", "qty_added", "qty_removed"))


@query
def job_gold_sales(spark: SparkSession, sf: str) -> DataFrame:
    """The whole history classified, then two days' sales, one of them run twice."""
    with _databases(spark, "history", "sales") as (db, out):
        sinks.append_table(_transactions(spark, sf), f"{db}.transactions")
        silver_jobs.transactions_backfill(spark, db, out)
        for day in (SNAPSHOT, "1998-06-16", SNAPSHOT):
            gold_jobs.sales(spark, day, out, out)
        return checkpointed(spark.table(f"{out}.daily_customer_sales"))


@query
def job_published_sales(spark: SparkSession, sf: str) -> DataFrame:
    """A day's sales, read from the external table that is registered over their files for analysts."""
    with _databases(spark, "published_history", "published_sales", "analytics") as (db, out, analytics):
        sinks.append_table(_transactions(spark, sf), f"{db}.transactions")
        silver_jobs.transactions_backfill(spark, db, out)
        gold_jobs.sales(spark, SNAPSHOT, out, out)
        (table,) = publish_jobs.publish(spark, ["daily_customer_sales", "absent"], out, analytics)
        return checkpointed(spark.table(table))


@query
def stream_ingest_restarted(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of record files into the raw table: it ends, and another one goes on from its checkpoint with what has come since."""
    with _databases(spark, "stream") as (db,), _folders(spark, "records", "ingest") as (files, checkpoint):

        def ingest() -> None:
            records = stream.read_events_stream(spark, "parquet", path=files, maxFilesPerTrigger="2")
            stream.start_ingest(records, f"{db}.events", checkpoint, True, "topic", F.col("timestamp")).awaitTermination()

        _delivered(spark, conform.event_records(spark, sf), F.col("partition") < 5, files, ingest)
        return checkpointed(spark.table(f"{db}.events").drop("raw_metadata", "_ingested_at", ledger.BATCH))


@query
def stream_sales_by_item(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of each item, kept by a stream that ends half-way and goes on from its checkpoint, and merged into a table."""
    with _databases(spark, "totals") as (db,), _folders(spark, "sales", "totals") as (files, checkpoint):

        def total() -> None:
            sales = stream.parse_sales(stream.read_events_stream(spark, "parquet", path=files))
            stream.start_totals(sales, f"{db}.totals", checkpoint, 150000, True).awaitTermination()

        records = _sale_records(spark, sf)
        records = records.select(F.lit(None).cast("binary").alias("key"), "value", F.lit("sales").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))
        _delivered(spark, records, F.col("timestamp") < "2024-01-16", files, total)
        return checkpointed(spark.table(f"{db}.totals"))
