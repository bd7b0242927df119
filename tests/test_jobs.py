"""Daily jobs: empty days, absent tables, rules and counts; and the plans they share."""

import datetime as dt
import decimal

import pytest
from lakeshore import conform, queries
from lakeshore.jobs import bronze, gold, publish, silver
from lakeshore.operators.upsert import upsert
from lakeshore.plans import bronze as raw
from lakeshore.plans import gold as marts
from lakeshore.plans import silver as conformed
from lakeshore.sources import sinks
from pyspark.sql import functions as F

from tests.skew import splits


@pytest.fixture
def db(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS jobs")
    yield "jobs"
    for t in spark.catalog.listTables("jobs"):
        spark.sql(f"DROP TABLE jobs.{t.name}")


def test_dimensions_from_load_to_conformed(spark, sf, db):
    frames = {"customers": conform.customers(spark, sf), "products": conform.products(spark, sf), "branches": conform.branches(spark, sf), "category": conform.categories(spark, sf)}
    for name, df in frames.items():
        assert bronze.load_dimension(lambda table, _: frames[table], name, "2024-01-05", db) == df.count()
        assert bronze.load_dimension(lambda table, _: frames[table].limit(0), name, "2024-01-06", db) == 0
        assert "report_date" in spark.table(f"{db}.{name}").columns
    spark.sql("CREATE DATABASE IF NOT EXISTS jobs_out")
    days = [r[0] for r in spark.table(f"{db}.customers").select("report_date").distinct().orderBy("report_date").collect()]
    for name in ("category", "customers", "products", "branches"):
        before = 0
        for day in [*days[::6], days[0]]:
            silver.dimension(spark, name, day, db, "jobs_out")
            n = spark.table(f"jobs_out.{name}").count() if spark.catalog.tableExists(f"jobs_out.{name}") else 0
            assert n >= before
            before = n
        assert silver.dimension(spark, name, "19000101", db, "jobs_out") == 0
        key = silver.DIMENSIONS[name][0]
        assert 0 < before == spark.table(f"jobs_out.{name}").select(key).distinct().count()
    spark.sql("DROP DATABASE jobs_out CASCADE")


def test_absent_and_empty_days(spark, db):
    assert silver.events(spark, "cart", "2024-01-05", db, db) == 0 and gold.events(spark, "cart", "2024-01-05", db, db) == 0
    sinks.append_table(queries._raw_events(spark, "/root/testdata/sf0.001"), f"{db}.behavior_events", ["log_date"])
    assert silver.events(spark, "cart", "2024-01-05", db, db) > 0 and silver.events(spark, "cart", "1999-01-01", db, db) == 0
    for _ in range(2):
        n = gold.events(spark, "cart", "2024-01-05", db, "jobs_gold")
        assert n == spark.table("jobs_gold.events_cart").count() == marts.gold_events(spark.table(f"{db}.events_cart"), "cart").count() > 0
    assert gold.events(spark, "cart", "1999-01-01", db, "jobs_gold") == 0 and spark.table("jobs_gold.events_cart").count() == n
    spark.sql("DROP DATABASE jobs_gold CASCADE")


def test_plans_of_the_marts(spark, sf):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    rolled = plan(raw.rollup_details(*conform.order_lines(spark, sf)))
    assert "Expand" not in rolled and rolled.count("Aggregate") == 1
    events = plan(queries._events(spark, sf))
    assert events.count("Relation") == 1 and events.count("Window [") == 1


def test_orders_without_a_customer_are_spread(spark):
    """Two thirds have none; the join on customers is either even or split, and they have neither type nor first day."""
    orders = spark.range(20000).selectExpr(
        "cast(id AS string) AS transaction_id", "'b1' AS branch_id", "timestamp_ntz'2024-01-05 10:00:00' AS transaction_datetime", "'cash' AS payment_type", "cast(1 AS decimal(15,2)) AS trans_total_amount",
        "if(id % 3 = 0, concat('c', id), null) AS customer_id", "'W' AS order_status", "'online' AS channel", "timestamp_ntz'2024-01-05 10:00:00' AS created_at", "timestamp_ntz'2024-01-05 10:00:00' AS updated_at", "timestamp_ntz'2024-01-05 10:00:00' AS _loaded_at",
    )
    got = conformed.classify_history(orders)
    assert not splits(spark, lambda: got)
    assert got.where("customer_id is null and (user_type is not null or NOU <> 0 or nou_ymd is not null)").count() == 0
    assert got.where("customer_id is not null and user_type = 1 and NOU = 1").count() == 6667 and got.count() == 20000


def test_upsert_keeps_repeated_source_rows(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    source = spark.createDataFrame([("a", 2), ("a", 3), (None, 4)], "k string, v int")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(upsert(target, source, ["k"], update=True)) == [("a", 2), ("a", 3), ("b", 1), (None, 4)]
    assert rows(upsert(target, source, ["k"])) == [("a", 1), ("b", 1), (None, 4)]
    with pytest.raises(ValueError):
        sinks.merge_table(source, "jobs.repeated", ["k"], update=True)


def test_marts_equal_the_buckets_together(spark, sf):
    events, raw_ = queries._events(spark, sf), queries._raw_events(spark, sf)
    want = None
    for bucket in ("discovery", "cart", "checkout"):
        part = conformed.silver_events(raw_, bucket).groupBy("event_type").agg(F.count("*").alias("n"))
        want = part if want is None else want.unionByName(part)
    assert sorted(map(tuple, events.groupBy("event_type").count().collect())) == sorted(map(tuple, want.collect()))
    assert marts.app_health_hourly(events).agg(F.sum("total_count")).first()[0] == events.count()


def test_a_day_of_orders_is_a_partition(spark, sf, db):
    """The daily loads' own layout, for a few days of orders and of their lines."""
    few = [df.where("updated_at < timestamp_ntz'1995-01-12'") for df in conform.orders(spark, sf)]
    lines = [df.where("created_at < timestamp_ntz'1995-01-12'") for df in conform.order_lines(spark, sf)]
    got = bronze.load_transactions(lambda name, _: few[name.startswith("online")], "1", db)
    assert got == spark.table(f"{db}.transactions").count() == sum(df.count() for df in few) > 0
    n = bronze.load_transaction_details(lambda name, _: lines[name.startswith("online")], "1", db)
    assert n == spark.table(f"{db}.transaction_details").count() > 0
    for table in ("transactions", "transaction_details"):
        parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.{table}").collect()}
        assert parts == {f"report_date={r[0]}" for r in spark.table(f"{db}.{table}").select("report_date").distinct().collect()}


def test_days_of_orders_in_their_own_layout(spark, db):
    """Three days, of which the second changes an order of the first and brings one of an earlier month; by branch, month and day."""
    day = lambda d, hour=10: dt.datetime(2024, d // 100, d % 100, hour)
    order = lambda k, who, made, changed, status="W", branch="b1": (k, branch, made, "cash", decimal.Decimal("5.00"), who, status, "online", made, changed, changed)
    loads = {
        "20240210": [order("1", "ann", day(210), day(210)), order("2", "bob", day(210, 11), day(210), branch="b2"), order("3", None, day(210), day(210))],
        "20240211": [order("1", "ann", day(210), day(211), "I"), order("4", "bob", day(105), day(211), branch="b2"), order("5", "ann", day(211), day(211))],
        "20240405": [order("6", "ann", day(405), day(405)), order("7", "bob", day(405), day(405), branch="b2")],
    }
    schema = "transaction_id string, branch_id string, transaction_datetime timestamp_ntz, payment_type string, trans_total_amount decimal(15,2), customer_id string, order_status string, channel string, created_at timestamp_ntz, updated_at timestamp_ntz, _loaded_at timestamp_ntz"
    for load, rows in loads.items():
        sinks.append_table(spark.createDataFrame(rows, schema).withColumn("report_date", F.lit(load)), f"{db}.transactions", ["report_date"])
        silver.nou(spark, load, db, "jobs_silver", buckets=4)
        assert silver.transactions(spark, load, db, "jobs_silver") == len(rows)
    got = {r.trans_id.split("_")[-1]: (r.order_status, r.user_type, r.NOU, r.ym) for r in spark.table("jobs_silver.transactions").collect()}
    assert got == {"1": ("I", 1, 1, "202402"), "2": ("W", 1, 1, "202402"), "3": ("W", None, 0, "202402"), "4": ("W", 1, 1, "202401"), "5": ("W", 1, 0, "202402"), "6": ("W", 3, 0, "202404"), "7": ("W", 3, 0, "202404")}
    assert {r.customer_id: r.nou_ymd for r in spark.table("jobs_silver.nou").collect()} == {"ann": "20240210", "bob": "20240105"}
    parts = {r[0] for r in spark.sql("SHOW PARTITIONS jobs_silver.transactions").collect()}
    assert "branch_id=b1/ym=202402/ymd=20240210" in parts and "branch_id=b2/ym=202401/ymd=20240105" in parts and len(parts) == 6
    assert sinks.rules_of(spark, "jobs_silver.transactions") == conformed.TRANSACTION_RULES
    spark.sql("DROP DATABASE jobs_silver CASCADE")


def test_published_tables_follow_their_files(spark, db):
    one = spark.createDataFrame([("a", 1, "x")], "k string, v int, part string")
    sinks.append_table(one, f"{db}.mart", ["part"])
    assert publish.publish(spark, ["mart", "absent"], db, "analysts") == ["analysts.mart"]
    sinks.append_table(one.withColumn("part", F.lit("y")), f"{db}.mart")
    assert publish.publish(spark, ["mart"], db, "analysts") == ["analysts.mart"]
    assert sorted(map(tuple, spark.table("analysts.mart").collect())) == [("a", 1, "x"), ("a", 1, "y")]
    spark.sql("DROP TABLE analysts.mart")
    assert spark.table(f"{db}.mart").count() == 2  # an external table leaves the files
    spark.sql("DROP DATABASE analysts CASCADE")


def test_a_delivery_that_comes_twice_is_parsed_once(spark, sf, monkeypatch):
    parsed, append = [], sinks.append_table

    def seen(df, *more):
        parsed.append("from_json" in df._jdf.queryExecution().optimizedPlan().toString())
        return append(df, *more)

    monkeypatch.setattr(sinks, "append_table", seen)
    assert queries.job_silver_events_cart(spark, sf).count() == queries.silver_events_cart(spark, sf).count()
    assert parsed == [False, False]


def test_whole_orders_are_joined_once_by_customer(spark, sf, db, monkeypatch):
    """The customers' months and first orders are one aggregate; the backfill reads the registry that it wrote, and the snapshot of a day holds what its marts read."""
    plan = queries._classified(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2 and plan.count("Window [") == 2
    made, first = [], conformed.first_orders
    monkeypatch.setattr(conformed, "first_orders", lambda df: made.append(df) or first(df))
    sinks.append_table(queries._transactions(spark, sf), f"{db}.transactions")
    silver.transactions_backfill(spark, db, "jobs_backfill")
    assert len(made) == 1
    kept, prepare = [], marts.daily_customer_sales
    monkeypatch.setattr(marts, "daily_customer_sales", lambda df: kept.append(df.columns) or prepare(df))
    assert gold.sales(spark, queries.SNAPSHOT, "jobs_backfill", "jobs_backfill") > 0
    assert kept == [marts.MART_COLUMNS]
    spark.sql("DROP DATABASE jobs_backfill CASCADE")
