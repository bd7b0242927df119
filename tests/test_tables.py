"""Catalog tables and database reads."""

import datetime as dt
import re

import pytest
from lakeshore.jobs import bronze, history
from lakeshore.plans import silver
from lakeshore.sources import sinks, tables
from pyspark.sql import functions as F

SCHEMA = "k string, v int, branch string, ymd string"


@pytest.fixture
def db(spark):
    yield "shop"
    for t in spark.catalog.listTables("shop"):
        spark.sql(f"DROP TABLE shop.{t.name}")


def rows(df):
    return sorted(map(tuple, df.select("k", "v", "branch", "ymd").collect()), key=str)


def test_append_and_read(spark, db):
    df = spark.createDataFrame([("a", 1, "b1", "20240101"), ("b", 2, "b2", "20240102")], SCHEMA)
    assert not sinks.append_table(df.limit(0), "shop.t", ["branch", "ymd"]) and not (spark.catalog.databaseExists("shop") and spark.catalog.tableExists("shop.t"))
    assert sinks.append_table(df, "shop.t", ["branch", "ymd"]) and sinks.append_table(df, "shop.t")
    got = tables.read_table(spark, "shop", "t", {"ymd": "20240102", "": 3, "branch": None})
    assert rows(got) == [("b", 2, "b2", "20240102")] * 2 and dict(got.dtypes)["ymd"] == "string"
    assert tables.read_table(spark, "shop", "absent", missing_ok=True, schema=SCHEMA).count() == 0


def test_replace_where_drops_vanished_branches(spark, db):
    day = spark.createDataFrame([("a", 1, "b1", "20240101"), ("b", 2, "b2", "20240101"), ("c", 3, "b1", "20240102")], SCHEMA)
    sinks.replace_where(day, "shop.g", "ymd", "20240101", ["branch", "ymd"])
    again = spark.createDataFrame([("a", 5, "b1", "20240101")], SCHEMA)
    for _ in range(2):
        sinks.replace_where(again, "shop.g", "ymd", "20240101")
        assert rows(spark.table("shop.g")) == [("a", 5, "b1", "20240101"), ("c", 3, "b1", "20240102")]
    assert sorted(r[0] for r in spark.sql("SHOW PARTITIONS shop.g").collect()) == ["branch=b1/ymd=20240101", "branch=b1/ymd=20240102"]


def test_merge_moves_rows_between_partitions(spark, db):
    first = spark.createDataFrame([("a", 1, "b1", "1"), ("b", 1, "b2", "1"), ("z", 1, "b3", "1")], SCHEMA)
    sinks.merge_table(first, "shop.m", ["k"], ["branch"])
    new = spark.createDataFrame([("a", 2, "b2", "2"), ("c", 2, "b1", "2"), ("z", 2, "b4", "2")], SCHEMA)
    want = [("a", 2, "b2", "2"), ("b", 1, "b2", "1"), ("c", 2, "b1", "2"), ("z", 2, "b4", "2")]
    for _ in range(2):
        sinks.merge_table(new, "shop.m", ["k"], update=True)
        assert rows(spark.table("shop.m")) == want
    assert sorted(r[0] for r in spark.sql("SHOW PARTITIONS shop.m").collect()) == ["branch=b1", "branch=b2", "branch=b4"]
    sinks.merge_table(spark.createDataFrame([("a", 9, "b9", "9"), ("n", 9, "b9", "9")], SCHEMA), "shop.m", ["k"])
    assert rows(spark.table("shop.m")) == [*want[:3], ("n", 9, "b9", "9"), want[3]]
    with pytest.raises(ValueError):
        sinks.merge_table(new.union(new), "shop.m", ["k"], update=True)
    with pytest.raises(Exception, match="constraint"):
        sinks.merge_table(new, "shop.m", ["k"], update=True, rules={"none": "v < 0"})


def test_merge_without_partitions_and_overwrite(spark, db):
    df = spark.createDataFrame([("a", 1, "b", "1")], SCHEMA)
    sinks.merge_table(df, "shop.u", ["k"])
    sinks.merge_table(df.withColumn("v", F.lit(4)), "shop.u", ["k"], update=True)
    assert rows(spark.table("shop.u")) == [("a", 4, "b", "1")]
    sinks.overwrite_table(spark.table("shop.u").withColumn("v", F.col("v") + 1), "shop.u", ["ymd"])
    assert rows(spark.table("shop.u")) == [("a", 5, "b", "1")]


def files(spark, table):
    """The number of files in each partition of a table."""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    got = spark.table(table).groupBy(F.element_at(F.split(F.input_file_name(), "/"), -2).alias("p")).agg(F.countDistinct(name).alias("n"))
    return {r.p: r.n for r in got.collect()}


def test_a_partition_gets_one_small_file(spark, db):
    """However many tasks hold rows of it; for creating, appending, replacing and merging."""
    many = spark.range(0, 40000, 1, 16).select(F.col("id").cast("string").alias("k"), F.col("id").cast("int").alias("v"), F.concat(F.lit("b"), F.col("id") % 12).alias("branch"), F.lit("1").alias("ymd"))
    assert sinks.overwrite_table(many, "shop.files", ["branch"]) == 40000
    assert files(spark, "shop.files") == {f"branch=b{k}": 1 for k in range(12)}
    assert sinks.append_table(many, "shop.files") == 40000
    assert set(files(spark, "shop.files").values()) == {2}
    assert sinks.replace_where(many, "shop.files", "branch", "b3") == 3334 and files(spark, "shop.files")["branch=b3"] == 1
    sinks.overwrite_table(many, "shop.files", ["branch"])
    assert sinks.merge_table(many.where("id % 2 = 0").withColumn("v", F.lit(-1)), "shop.files", ["k"], update=True) == 20000
    assert set(files(spark, "shop.files").values()) == {1} and spark.table("shop.files").where("v = -1").count() == 20000


def test_a_large_partition_is_written_by_several_tasks(spark, db):
    rows = spark.range(0, 60000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.lit(1).alias("v"), F.when(F.col("id") < 50000, "large").otherwise(F.concat(F.lit("b"), F.col("id") % 3)).alias("branch"), F.lit("1").alias("ymd"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        sinks.overwrite_table(rows, "shop.large", ["branch"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    got = files(spark, "shop.large")
    assert 2 <= got.pop("branch=large") <= 16 and set(got.values()) == {1}


def scans(df):
    """The partition filters and numbers of partitions of the scans of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)


def test_a_merge_reads_only_the_partitions_of_its_source(spark, db):
    """One partition of fifty; a null one is among them, too, and one that exists only as a mixture of others' values."""
    rows = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.concat(F.lit("b"), F.col("id") % 5).alias("branch"), F.when(F.col("id") % 10 > 0, (F.col("id") % 10).cast("string")).alias("ymd"))
    sinks.merge_table(rows, "shop.pruned", ["k", "branch", "ymd"], ["branch", "ymd"])
    day = rows.where("k in ('1', '2', '10', '20')").withColumn("v", F.lit(2))
    merged, affected = sinks.merge_plan(day, "shop.pruned", ["k", "branch", "ymd"], update=True)
    assert affected == {("b1", "1"), ("b2", "2"), ("b0", None)}
    on_target = [f for f in scans(merged) if f]
    assert on_target and all("branch" in f and "IN" in f and "ymd" in f for f in on_target), on_target
    assert merged.select("branch", "ymd").distinct().count() == 3
    before = {r[0] for r in spark.table("shop.pruned").where("branch = 'b4'").select(F.input_file_name()).distinct().collect()}
    sinks.merge_table(day, "shop.pruned", ["k", "branch", "ymd"], update=True)
    # Two of the four have a null in their key, which matches nothing.
    assert spark.table("shop.pruned").where("v = 2").count() == 4 and spark.table("shop.pruned").count() == 502
    assert before == {r[0] for r in spark.table("shop.pruned").where("branch = 'b4'").select(F.input_file_name()).distinct().collect()}
    # A key without the partition's columns may move: its old place is found, and then the scan of whole rows is pruned, too.
    moved, affected = sinks.merge_plan(day.withColumn("ymd", F.lit("new")), "shop.pruned", ["k"], update=True)
    assert ("b1", "new") in affected and ("b1", "1") in affected and len(affected) == 6
    assert any("branch" in f and "IN" in f for f in scans(moved))


def test_a_merge_without_update_writes_only_what_is_absent(spark, db, tmp_path):
    """Files that are there stay, null keys match nothing, and rows that a broken append left in a partition unknown to the catalog come once."""
    row = lambda k, ymd: (k, 1, "b", ymd)
    frame = lambda *rows: spark.createDataFrame(rows, SCHEMA)
    paths = lambda: {r[0] for r in spark.table("shop.absent").select(F.input_file_name()).distinct().collect()}
    sinks.merge_table(frame(row("a", "1"), row("b", "2"), row("n", None)), "shop.absent", ["k", "ymd"], ["ymd"])
    before = paths()
    (at,) = [r.data_type for r in spark.sql("DESCRIBE FORMATTED shop.absent").collect() if r.col_name == "Location"]
    frame(row("left", "3")).drop("ymd").write.parquet(f"{at}/ymd=3")
    new = frame(row("a", "1"), row("c", "1"), row("left", "3"), row("d", "3"), row("n", None))
    for extra in (1, 2):
        assert sinks.merge_table(new, "shop.absent", ["k", "ymd"]) == 5
        want = [row("a", "1"), row("b", "2"), row("c", "1"), row("d", "3"), row("left", "3"), *[row("n", None)] * (1 + extra)]
        assert sorted(map(tuple, spark.table("shop.absent").collect()), key=repr) == sorted(want, key=repr)
    assert before <= paths()


def test_rules_stay_with_a_table(spark, db):
    good = spark.createDataFrame([("a", 1, "b1", "1"), ("b", None, "b2", "1")], SCHEMA)
    bad = spark.createDataFrame([("c", -1, "b1", "1")], SCHEMA)
    sinks.append_table(good, "shop.ruled", ["branch"])
    for _ in range(2):
        sinks.add_rules(spark, "shop.ruled", {"positive": "v > 0", "name": "k <> 'it\\'s'"})
    assert sinks.rules_of(spark, "shop.ruled") == {"positive": "v > 0", "name": "k <> 'it\\'s'"}
    with pytest.raises(ValueError, match="constraint big"):
        sinks.add_rules(spark, "shop.ruled", {"big": "v > 1", "positive": "v > 0"})
    for write in (
        lambda df: sinks.append_table(df, "shop.ruled"), lambda df: sinks.overwrite_table(df, "shop.ruled", ["branch"]), lambda df: sinks.replace_where(df, "shop.ruled", "branch", "b1"),
        lambda df: sinks.merge_table(df, "shop.ruled", ["k"]), lambda df: sinks.merge_table(df, "shop.ruled", ["k"], update=True),
    ):
        before = rows(spark.table("shop.ruled"))
        with pytest.raises(Exception, match="constraint positive"):
            write(bad)
        assert rows(spark.table("shop.ruled")) == before and before  # what was there still is
        assert sinks.rules_of(spark, "shop.ruled") == {"positive": "v > 0", "name": "k <> 'it\\'s'"}
        write(good)
    sinks.overwrite_table(spark.table("shop.ruled").where("k = 'a'").limit(1), "shop.ruled", ["branch"])
    assert sinks.rules_of(spark, "shop.ruled") == {"positive": "v > 0", "name": "k <> 'it\\'s'"}
    sinks.drop_rule(spark, "shop.ruled", "positive")
    assert sinks.append_table(bad, "shop.ruled") == 1
    # Rules that a merge brings stay with the table that it makes.
    sinks.merge_table(good, "shop.made", ["k"], rules={"positive": "v > 0"})
    with pytest.raises(Exception, match="constraint positive"):
        sinks.append_table(bad, "shop.made")


def test_a_bucketed_registry_is_not_exchanged(spark, db):
    """The scan of the registry goes into the join as it is; a merge keeps the buckets, and one file for each in a month."""
    customers = spark.range(2000).select(F.concat(F.lit("c"), "id").alias("customer_id"), F.concat(F.lit("2024010"), F.col("id") % 9 + 1).alias("nou_ymd"), F.lit("202401").alias("ym"))
    sinks.merge_table(customers.limit(1500), "shop.nou", ["customer_id"], ["ym"], update=True, buckets=(8, "customer_id"))
    sinks.merge_table(customers, "shop.nou", ["customer_id"], update=True)
    assert sinks.buckets_of(spark, "shop.nou") == (8, "customer_id") and spark.table("shop.nou").count() == 2000
    assert files(spark, "shop.nou") == {"ym=202401": 8}
    at = F.lit("2024-02-05 10:00:00").cast("timestamp_ntz")
    orders = spark.range(3000).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("b1").alias("branch_id"), at.alias("transaction_datetime"), F.lit("cash").alias("payment_type"), F.lit(1).cast("decimal(15,2)").alias("trans_total_amount"),
        F.concat(F.lit("c"), F.col("id") % 2000).alias("customer_id"), F.lit("W").alias("order_status"), F.lit("online").alias("channel"), at.alias("created_at"), at.alias("updated_at"), at.alias("_loaded_at"),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = silver.classify_transactions(orders, spark.table("shop.nou"), spark.createDataFrame([], "customer_id string, ym string"))
        assert got.where("user_type = 3").count() == 3000
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    (scan,) = [k for k, line in enumerate(plan) if "FileScan parquet" in line and "nou" in line]
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above, own = [], depth(plan[scan])
    for line in reversed(plan[:scan]):
        if depth(line) < own:
            own = depth(line)
            above.append(line)
            if "Join" in line:
                break
    assert "Join" in above[-1] and not any("Exchange" in line or "ShuffleQueryStage" in line for line in above), above
    assert "Bucketed: true" in plan[scan]


def test_changes_arrive_once(spark, tmp_path):
    """Rows that change between two runs, across midnight, and one that is committed late; a run that breaks before it moves the mark is repeated."""
    url, driver = f"jdbc:derby:{tmp_path}/marks;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    at = lambda day, hour, minute=0: dt.datetime(2024, 1, day, hour, minute)

    def write(rows):
        df = spark.createDataFrame([(k, n, c, u) for k, n, c, u in rows], "category_id string, category_name string, created_at timestamp, updated_at timestamp").withColumn("is_current", F.lit(True))
        df.write.jdbc(url, "category", properties=driver | {"createTableColumnTypes": "category_id varchar(20), category_name varchar(20)"}, mode="overwrite")

    columns = ('"updated_at"', '"created_at"')
    read = lambda since: tables.read_jdbc(spark, url, "category", tables.since_condition(since, columns), properties=driver)
    spark.sql("CREATE DATABASE IF NOT EXISTS marks")
    load = lambda: bronze.load_changes(spark, read, "category", "category_id", "marks")
    got = lambda: sorted((r.category_id, r.category_name) for r in spark.table("marks.category").collect())
    first = [("a", "A", at(5, 22), None), ("b", "B", at(5, 10), at(5, 23, 50)), ("n", "no time", None, None)]
    write(first)
    assert load() == 3 and load() == 0 and bronze.high_water(spark, "category", "marks") == at(5, 23, 50)
    write([("a", "A2", at(5, 22), at(6, 0, 5)), *first[1:], ("c", "C", at(5, 23, 59), None), ("late", "L", at(5, 23, 20), None)])
    assert load() == 3 and load() == 0
    assert got() == [("a", "A"), ("a", "A2"), ("b", "B"), ("c", "C"), ("late", "L"), ("n", "no time")]
    sinks.overwrite_table(spark.createDataFrame([("category", at(5, 23, 50))], "source string, changed_at timestamp_ntz"), "marks.high_water")
    assert load() == 0 and bronze.high_water(spark, "category", "marks") == at(6, 0, 5)
    spark.sql("DROP DATABASE marks CASCADE")
    with pytest.raises(ValueError):
        tables.read_jdbc(spark, url, "category", parts=2, properties=driver)


def test_a_history_leaves_closed_versions_alone(spark, db):
    day = lambda n: dt.datetime(2024, 1, n)
    load = lambda name, *rows: history.merge_history(spark.createDataFrame(list(rows), "k string, v int, at timestamp_ntz"), "shop.past", "k", "at", name)
    assert load("1", ("a", 1, day(1)), ("b", 1, day(1)), ("c", 1, day(1))) == 3
    assert load("2", ("a", 2, day(2)), ("b", 0, day(1)), ("d", 1, day(2))) == 2
    closed = {r[0] for r in spark.table("shop.past").where("closed_in = '2'").select(F.input_file_name()).collect()}
    assert load("3", ("a", 3, day(3)), ("b", 3, day(3))) == 2 and load("3", ("a", 3, day(3)), ("b", 3, day(3))) == 0
    assert load("3", ("c", 3, day(3))) == 1  # the same load brings more
    assert closed == {r[0] for r in spark.table("shop.past").where("closed_in = '2'").select(F.input_file_name()).collect()}
    got = sorted((r.k, r.v, r.valid_from.day, r.valid_to and r.valid_to.day, r.closed_in) for r in spark.table("shop.past").collect())
    assert got == [("a", 1, 1, 2, "2"), ("a", 2, 2, 3, "3"), ("a", 3, 3, None, "open"), ("b", 1, 1, 3, "3"), ("b", 3, 3, None, "open"), ("c", 1, 1, 3, "3"), ("c", 3, 3, None, "open"), ("d", 1, 2, None, "open")]
    changes = sorted((r.load, r.k, r._change, r.v) for r in spark.table("shop.past__changes").where("load > '1'").collect())
    assert changes == [
        ("2", "a", "update_postimage", 2), ("2", "a", "update_preimage", 1), ("2", "d", "insert", 1), ("3", "a", "update_postimage", 3), ("3", "a", "update_preimage", 2),
        ("3", "b", "update_postimage", 3), ("3", "b", "update_preimage", 1), ("3", "c", "update_postimage", 3), ("3", "c", "update_preimage", 1),
    ]
    with pytest.raises(ValueError):
        load("4", ("a", 4, day(4)), ("a", 5, day(5)))


def test_register(spark, db, tmp_path):
    at = str(tmp_path / "files")
    spark.createDataFrame([("a", 1, "b", "20240101")], SCHEMA).write.partitionBy("ymd").parquet(at)
    for _ in range(2):
        sinks.register_table(spark, "shop.r", at, SCHEMA, ["ymd"])
    assert rows(spark.table("shop.r")) == [("a", 1, "b", "20240101")] and dict(spark.table("shop.r").dtypes)["ymd"] == "string"


def test_day_predicates():
    one, = tables.day_predicates("2024-02-28", ("updated_at", "created_at"))
    assert "updated_at >= TIMESTAMP('2024-02-28 00:00:00') AND updated_at < TIMESTAMP('2024-02-29 00:00:00')" in one and "updated_at IS NULL" in one
    assert len(tables.day_predicates("2024-02-28", ("a",), 3, "id")) == 3


def test_incremental_read(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/erp;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    day = dt.datetime(2024, 1, 5)
    data = [
        ("c1", "First", day.replace(hour=1), None), ("c2", "Second", day.replace(day=1), day.replace(hour=23)), ("c3", "Third", day, day.replace(day=6)), ("c4", "Fourth", None, None),
    ]
    df = spark.createDataFrame([(*r, n) for n, r in enumerate(data)], "category_id string, category_name string, created_at timestamp, updated_at timestamp, n int").withColumn("is_current", F.lit(True))
    df.write.jdbc(url, "category", properties=driver | {"createTableColumnTypes": "category_id varchar(20), category_name varchar(20)"}, mode="overwrite")
    every = [tables.read_jdbc(spark, url, "category", where, parts, '"n"', driver) for where, parts in ((None, 1), (None, 3), ('"n" < 2', 2))]
    assert [sorted(r.category_id for r in df.collect()) for df in every] == [["c1", "c2", "c3", "c4"]] * 2 + [["c1", "c2"]] and every[1].columns == every[2].columns
    for parts in (1, 3):
        got = tables.read_jdbc_incremental(spark, url, "category", "2024-01-05", ('"updated_at"', '"created_at"'), parts, '"n"', driver)
        assert sorted(r.category_id for r in got.collect()) == ["c1", "c2"] and got.rdd.getNumPartitions() == parts
        assert got.columns == ["category_id", "category_name", "is_current", "created_at", "updated_at"]
