"""Inputs in the shape of the retailer's sources, made from generic star-schema tables for tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.clean import epoch_seconds
from .functions.vocabulary import EVENT_TYPES, STATUSES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as topic records. Every tenth event comes again an hour later, with ten units more."""
    # A user's records come together, as a partition of their topic would bring them.
    e = table(spark, sf_dir, "events").repartition(F.col("user_id"))
    n = F.col("event_id")
    number = 1 + n % 14
    sent = e.withColumn("late", F.explode(F.when(n % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    when = lambda *ids: lambda value: F.when(number.isin(*ids), value)
    product = F.concat(F.lit("p"), n % 50)
    metadata = F.struct(
        when(*range(1, 9))(F.col("event_type")).alias("source_screen"),
        when(3)((n % 10).cast("int")).alias("position"),
        when(2)(F.concat(F.lit("  Blue   SHIRT "), n % 7, F.lit(" "))).alias("search_keyword"),
        when(2)((n % 30).cast("int")).alias("result_count"),
        when(3, 4, 5, 7, 8)(product).alias("product_id"),
        when(4)(F.lit("size")).alias("variant_type"),
        when(4)(F.lit("M")).alias("variant_value"),
        when(5)((1 + n % 3 + 10 * F.col("late")).cast("int")).alias("quantity"),
        when(7)((1 + n % 2).cast("int")).alias("removed_quantity"),
        when(8)((n % 4).cast("int")).alias("old_quantity"),
        when(8)((n % 5).cast("int")).alias("new_quantity"),
        when(6)((n % 9).cast("int")).alias("total_items"),
        when(6)((n % 9) * 1000).alias("cart_total_value"),
        when(9)(F.array(product, F.concat(F.lit("q"), n % 3))).alias("items_list"),
        when(10)(F.element_at(F.array(F.lit("post"), F.lit("courier")), (1 + n % 2).cast("int"))).alias("shipping_method"),
        when(10)(F.concat(F.lit("City "), n % 6)).alias("city_province"),
        when(11)(F.concat(F.lit("promo"), n % 4)).alias("promotion_id"),
        when(11)(F.when(n % 5 == 0, 0).otherwise(1)).alias("is_valid"),
        F.when((number == 11) & (n % 5 == 0), "expired").alias("error_message"),
        when(12)(F.element_at(F.array(F.lit("card"), F.lit("cod"), F.lit("wallet")), (1 + n % 3).cast("int"))).alias("payment_method"),
        when(13)(F.floor(F.col("value") * 100)).alias("final_amount"),
        when(13)(F.concat(F.lit("o"), n)).alias("order_id"),
        when(14)(F.when(n % 6 == 0, 0).otherwise(1)).alias("is_success"),
        F.when((number == 14) & (n % 6 == 0), F.concat(F.lit("E"), n % 3)).alias("error_code"),
    )
    envelope = F.struct(
        F.when(n % 97 != 0, F.concat(F.lit("ev-"), n)).alias("event_uuid"),
        number.cast("int").alias("event_id"),
        F.element_at(F.array(*map(F.lit, EVENT_TYPES)), number.cast("int")).alias("event_type"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
        F.date_format("ts", "yyyy-MM-dd").alias("log_date"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
        F.concat(F.lit("u"), F.col("user_id"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.concat(F.lit("u"), F.col("user_id")).alias("user_id"),
        F.when(F.col("user_id") % 2 == 0, "iOS").otherwise("Android").alias("device_os"),
        F.concat(F.lit("1."), F.col("user_id") % 3).alias("app_version"),
        metadata.alias("metadata"),
    )
    at = F.timestamp_add("HOUR", F.col("late"), F.col("ts").cast("timestamp"))
    return sent.select(
        F.col("user_id").cast("string").cast("binary").alias("key"), F.to_json(envelope).cast("binary").alias("value"), F.lit("behavior_events").alias("topic"),
        (F.col("user_id") % 10).cast("int").alias("partition"), (2 * n + F.col("late")).alias("offset"), at.alias("timestamp"),
    )


def orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """`orders` as POS and online headers; every seventh order has an older snapshot in which it waits."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    at = F.timestamp_add("SECOND", (k % 86400).cast("int"), F.col("o_orderdate").cast("timestamp_ntz"))
    updated = F.timestamp_add("DAY", (k % 40).cast("int"), F.col("o_orderdate").cast("timestamp_ntz"))
    o = table(spark, sf_dir, "orders").withColumn("old", F.explode(F.when(k % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    both = o.select(
        k.cast("string").alias("transaction_id"),
        F.concat(F.lit("b"), c % 5).alias("branch_id"),
        at.alias("transaction_datetime"),
        F.col("o_orderpriority").alias("payment_type"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("trans_total_amount"),
        F.when(k % 53 != 0, F.concat(F.lit("c"), c)).alias("customer_id"),
        F.when(F.col("old") == 1, "W").otherwise(F.substring(F.lit(STATUSES), (1 + k % 9).cast("int"), F.lit(1))).alias("order_status"),
        F.col("o_orderdate").cast("date").alias("delivery_date"),
        at.alias("created_at"),
        F.when(F.col("old") == 1, F.col("o_orderdate").cast("timestamp_ntz")).otherwise(updated).alias("updated_at"),
        F.when(F.col("old") == 1, F.lit("2020-01-01 00:00:00")).otherwise(F.lit("2020-01-02 00:00:00")).cast("timestamp_ntz").alias("_loaded_at"),
        k.alias("k"),
    )
    pos = both.where("k % 2 = 0").withColumns({"trans_total_line": (F.col("k") % 8).cast("int"), "trans_total_sell_sku": (F.col("k") % 6).cast("int")})
    return pos.drop("k"), both.where("k % 2 = 1").drop("k")


def order_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """`lineitem` as POS and online order lines."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    both = l.select(
        F.concat(F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("transaction_detail_id"),
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.concat(F.lit("b"), F.col("l_suppkey") % 5).alias("branch_id"),
        F.concat(F.lit("p"), F.col("l_partkey")).alias("product_id"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_promo"),
        F.when(F.col("l_linestatus") == "O", "pc").alias("product_uom_code"),
        F.col("l_quantity").cast("int").alias("trans_qty"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("trans_line_amount"),
        F.when(F.col("l_linenumber") % 2 == 0, "M").alias("variant_size"),
        F.lit(None).cast("string").alias("variant_color"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("created_at"),
        "l_orderkey",
    )
    return both.where("l_orderkey % 2 = 0").drop("l_orderkey"), both.where("l_orderkey % 2 = 1").drop("l_orderkey", "branch_id")


def _day(n: Column) -> Column:
    return F.timestamp_add("DAY", n.cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`customer` with nations as addresses; every fourth customer has an older version."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.withColumn("old", F.explode(F.when(k % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    address = F.when(k % 19 == 0, "").otherwise(F.concat(F.lit("Street "), k, F.lit(", "), F.col("n_name")))
    return c.select(
        F.concat(F.lit("c"), k).alias("customer_id"),
        F.when(k % 20 != 0, F.concat(F.col("c_mktsegment"), F.when(F.col("old") == 1, F.lit(" before")).otherwise(F.lit("")))).alias("first_name"),
        F.when(k % 20 > 1, F.concat(F.lit(" Customer  "), k % 100)).alias("last_name"),
        F.when(k % 11 != 0, F.when(k % 13 == 0, "12").otherwise(F.concat(F.lit("09"), F.lpad(k.cast("string"), 8, "0")))).alias("phone"),
        F.date_add(F.lit("1980-01-01").cast("date"), (k % 9000).cast("int")).alias("dob"),
        (k % 80).cast("int").alias("age"),
        (k % 3).cast("int").alias("gender"),
        F.when(k % 17 != 0, address).alias("address_line"),
        F.when(k % 23 == 0, 1).otherwise(0).alias("is_deleted"),
        _day(k % 10).alias("registered_datetime"),
        _day(k % 10).alias("created_at"),
        _day(k % 10 + k % 5 - F.col("old")).alias("updated_at"),
        F.when(k % 2 == 0, "pos").otherwise("web").alias("source"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("p"), k).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.upper("p_name").alias("product_display_name"),
        F.col("p_type").alias("category_id"),
        F.element_at(F.array(F.lit("pc"), F.lit("box"), F.lit("set")), 1 + F.col("p_size") % 3).alias("sales_unit"),
        F.col("p_brand").alias("color"),
        F.col("p_size").cast("string").alias("size"),
        F.col("p_retailprice").cast("decimal(15,2)").alias("unit_price"),
        _day(k % 10).alias("created_at"),
        _day(k % 15).alias("updated_at"),
        (k % 9 != 0).alias("is_current"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product types as categories; those of one letter in five have no row."""
    t = table(spark, sf_dir, "part").select("p_type").distinct().where("length(p_type) % 5 <> 0")
    n = F.length("p_type")
    return t.select(F.col("p_type").alias("category_id"), F.initcap(F.lower("p_type")).alias("category_name"), (n % 3 != 0).alias("is_current"), _day(n % 10).alias("created_at"), _day(n % 15).alias("updated_at"))


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    s = s.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return s.select(
        F.concat(F.lit("b"), k).alias("branch_id"), F.col("s_name").alias("branch_name"), F.when(k % 2 == 0, "store").otherwise("outlet").alias("branch_type"), F.col("r_name").alias("region"),
        F.col("n_name").alias("city_province"), F.concat(F.lit("Ward "), k % 12).alias("ward"), F.when(k % 6 == 0, "closed").otherwise("open").alias("status"), F.date_add(F.lit("2010-01-01").cast("date"), (k % 3000).cast("int")).alias("open_date"),
        _day(k % 10).alias("created_at"), _day(k % 15).alias("updated_at"), (k % 9 != 0).alias("is_current"),
    )


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of `events` as sale lines: an item for each of fifty, one to three units, a price."""
    n = F.col("event_id")
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").select(
        F.col("ts").cast("timestamp_ntz").alias("event_time"), F.concat(F.lit("item "), n % 50).alias("item"), (1 + n % 3).alias("units"), ((1 + n % 3) * 150000).alias("revenue"), F.concat(F.lit("u"), F.col("user_id")).alias("buyer")
    )
