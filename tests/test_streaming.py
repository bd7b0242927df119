import datetime as dt
import json

import pytest

from lakeshore.plans import silver
from lakeshore import conform
from lakeshore.jobs import silver as jobs
from lakeshore.streaming import events as stream
from lakeshore.streaming import ledger
from pyspark.sql import functions as F


def test_stream_of_files_equals_batch(spark, sf, tmp_path):
    records = conform.event_records(spark, sf)
    files, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    spark.sql("DROP TABLE IF EXISTS raw.events")
    for part in range(3):
        records.where(F.col("offset") % 3 == part).write.mode("append").parquet(files)
        source = stream.read_events_stream(spark, "parquet", path=files)
        stream.start_ingest(source, "raw.events", checkpoint, available_now=True).awaitTermination()  # each goes on where the last ended
    got = spark.table("raw.events")
    assert got.count() == records.count()
    want = stream.parse_events(records)
    for bucket in ("cart", "checkout"):
        columns = [c for c in silver.silver_events(want, bucket).columns if c not in ("quantity", "items_list")]
        a, b = (sorted(map(str, silver.silver_events(df, bucket).select(*columns).collect())) for df in (got, want))
        assert a == b and a


def test_kafka_source_is_the_default():
    """The connector isn't on this class path: the reader is a stub that keeps what it is told."""

    class Reader:
        def format(self, name):
            self.name = name
            return self

        def options(self, **told):
            self.told = told
            return self

        def load(self):
            return self

    class Session:
        readStream = Reader()

    got = stream.read_events_stream(Session(), servers="localhost:1", maxOffsetsPerTrigger="9")
    want = {"kafka.bootstrap.servers": "localhost:1", "subscribe": "behavior_events", "startingOffsets": "earliest", "failOnDataLoss": "false"}
    assert got.name == "kafka" and got.told == want | {"maxOffsetsPerTrigger": "9"}


def test_await_any(spark, tmp_path):
    spark.streams.resetTerminated()
    assert stream.await_any(spark, 1) is False
    source = spark.readStream.format("rate").load()
    query = source.writeStream.format("noop").option("checkpointLocation", str(tmp_path)).start()
    query.stop()
    assert stream.await_any(spark, 20) is True
    spark.streams.resetTerminated()


def sale(kind, user="u1", **metadata):
    body = {"event_type": kind, "user_id": user} | ({"metadata": metadata} if metadata else {})
    return (None, json.dumps(body), "t", 0, 0, dt.datetime(2024, 1, 1))


SALES = [
    sale("item_sold", item="Coat", is_success=1, units=["A1", "A2"]), sale("item_sold", item="Hat", is_success=0, units=["A1"]), sale("item_sold", is_success=1), sale("item_sold"),
    sale("payment_failed", item="Hat", error_message="no funds"), sale("payment_failed"), sale("view_item", item="Hat"), sale("other"), (None, "broken", "t", 0, 0, None),
]
TEXT = stream.RECORD.replace("key binary, value binary", "key string, value string")


def test_alerts(spark):
    got = [tuple(r) for r in stream.route_alerts(stream.parse_sales(spark.createDataFrame(SALES, TEXT))).collect()]
    assert got == [
        ("sms", "u1", "Confirmed: Coat [A1, A2]"), ("sms", "u1", "Confirmed: Unknown []"), ("email", "u1", "Payment failed for Hat: no funds"),
        ("email", "u1", "Payment failed for Unknown: Unknown error"), ("push", "u1", "Offer for Hat"),
    ]


def test_running_sales_survive_a_restart(spark, tmp_path):
    files, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    seen = []
    for _ in range(2):
        spark.createDataFrame(SALES, TEXT).select(*[F.col(c).cast("binary") if c in ("key", "value") else c for c in ("key", "value", "topic", "partition", "offset", "timestamp")]).write.mode("append").parquet(files)
        sales = stream.parse_sales(stream.read_events_stream(spark, "parquet", path=files))
        totals = stream.running_sales(sales, 10).writeStream.outputMode("complete")
        query = totals.foreachBatch(lambda df, _: seen.append(tuple(df.first()))).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    assert seen == [(2, 20), (4, 40)]


@pytest.fixture
def db(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS streamed")
    yield "streamed"
    spark.sql("DROP DATABASE streamed CASCADE")


def batch(spark, ids, day="2024-01-01"):
    body = lambda i: json.dumps({"event_uuid": f"e{i}", "event_id": 5, "event_type": "add_to_cart", "timestamp": 1704067200, "log_date": day, "created_at": f"{day}T00:00:00", "user_id": "u1"})
    rows = [(None, body(i), "t", 0, i, dt.datetime(2024, 1, 1)) for i in ids]
    return spark.createDataFrame(rows, TEXT).withColumn("value", F.col("value").cast("binary"))


def test_a_batch_that_comes_again_writes_nothing(spark, db, monkeypatch):
    write, table = stream.write_bronze_batch(f"{db}.raw", query="q"), f"{db}.raw"
    uuids = lambda: sorted(r[0] for r in spark.table(table).select("event_uuid").collect())
    write(batch(spark, []), 0)
    assert not spark.catalog.tableExists(table)
    write(batch(spark, [1, 2]), 1)
    for _ in range(2):
        write(batch(spark, [1, 2]), 1)
        assert uuids() == ["e1", "e2"]
    stream.write_bronze_batch(table, query="another")(batch(spark, [3], "2024-01-02"), 1)
    assert uuids() == ["e1", "e2", "e3"]
    # A batch breaks after its rows are in the table, before it is done: the next attempt takes them away first.
    enter = ledger._enter
    monkeypatch.setattr(ledger, "_enter", lambda s, t, rows: enter(s, t, rows) if rows[0][2] == "begun" else (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        write(batch(spark, [4, 5]), 2)
    assert uuids() == ["e1", "e2", "e3", "e4", "e5"]
    monkeypatch.setattr(ledger, "_enter", enter)
    for _ in range(2):
        write(batch(spark, [4, 5]), 2)
        assert uuids() == ["e1", "e2", "e3", "e4", "e5"]
    assert {r.n_rows for r in spark.table(ledger.ledger_of(table)).where("epoch = 2 and state = 'done'").collect()} == {2}


def test_a_batch_is_counted_in_the_table_and_not_kept(spark, db, monkeypatch):
    """Counts for each partition, one of them null, without keeping the batch; also where files seem older than it, and beside other batches' rows."""
    kept, appended = [], ledger.appended
    monkeypatch.setattr(ledger, "appended", lambda df, *a: (kept.append(df.storageLevel.useMemory or df.storageLevel.useDisk), appended(df, *a))[1])
    both = lambda ids: batch(spark, ids).union(batch(spark, [9], "2024-01-02")).union(batch(spark, [8], "no day"))
    write, table = stream.write_bronze_batch(f"{db}.counted", query="q"), f"{db}.counted"
    write(both([1, 2, 3]), 0)
    monkeypatch.setattr(ledger, "CLOCKS", dt.timedelta(days=-1))
    write(both([4, 5]), 1)
    got = {(r.epoch, r.part): r.n_rows for r in spark.table(ledger.ledger_of(table)).where("state = 'done'").collect()}
    assert got == {(e, p): n for e, k in ((0, 3), (1, 2)) for p, n in (("2024-01-01", k), ("2024-01-02", 1), (None, 1))}
    assert kept == [False, False]


def test_late_events_of_a_finished_day_arrive(spark, db):
    write = stream.write_bronze_batch(f"{db}.behavior_events", query="q")
    got = lambda: sorted(r[0] for r in spark.table(f"{db}.events_cart").select("event_uuid").collect())
    assert jobs.events_due(spark, "cart", db, db) == 0
    write(batch(spark, [1]), 0)
    write(batch(spark, [2], "2024-01-02"), 1)
    assert jobs.events_due(spark, "cart", db, db) == 2 and jobs.events_due(spark, "cart", db, db) == 0
    write(batch(spark, [3], "2024-01-01"), 2)  # a day that is done
    assert [r.part for r in ledger.due(spark, f"{db}.behavior_events", f"{db}.events_cart").collect()] == ["2024-01-01"]
    assert jobs.events_due(spark, "cart", db, db) > 0 and got() == ["e1", "e2", "e3"]
    # Another consumer has marks of its own; another stream is read from its own first batch.
    assert {r.part for r in ledger.due(spark, f"{db}.behavior_events", f"{db}.events_checkout").collect()} == {"2024-01-01", "2024-01-02"}
    stream.write_bronze_batch(f"{db}.behavior_events", query="second")(batch(spark, [4]), 0)
    assert jobs.events_due(spark, "cart", db, db) > 0 and got() == ["e1", "e2", "e3", "e4"]


def test_a_failed_run_is_due_again(spark, db):
    write = stream.write_bronze_batch(f"{db}.behavior_events", query="q")
    write(batch(spark, [1]), 0)

    def broken(days):
        raise OSError(days)

    with pytest.raises(OSError):
        ledger.read_due(spark, f"{db}.behavior_events", f"{db}.out", broken)
    assert ledger.read_due(spark, f"{db}.behavior_events", f"{db}.out", len) == 1
    assert ledger.read_due(spark, f"{db}.behavior_events", f"{db}.out", len) == 0


def test_totals_by_item_go_on_after_a_restart(spark, db, tmp_path):
    files, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    seen = []
    for k in range(2):
        rows = SALES if k == 0 else [sale("item_sold", item="Hat", is_success=1, units=["A1"])]
        spark.createDataFrame(rows, TEXT).select(*[F.col(c).cast("binary") if c in ("key", "value") else c for c in ("key", "value", "topic", "partition", "offset", "timestamp")]).write.mode("append").parquet(files)
        sales = stream.parse_sales(stream.read_events_stream(spark, "parquet", path=files))
        stream.start_totals(sales, f"{db}.totals", checkpoint, 10, available_now=True).awaitTermination()
        spark.catalog.refreshTable(f"{db}.totals")  # the stream writes in a session of its own
        seen.append(sorted(map(tuple, spark.table(f"{db}.totals").collect())))
    assert seen == [[("Coat", 2, 20), ("Unknown", 0, 0)], [("Coat", 2, 20), ("Hat", 1, 10), ("Unknown", 0, 0)]]


def test_few_files_are_parsed_by_all_cores(spark, sf, tmp_path, monkeypatch):
    """A trigger of two files, each of one row group, would be parsed by two tasks."""
    files, sizes = str(tmp_path / "in"), []
    conform.event_records(spark, sf).coalesce(2).write.parquet(files)
    write = lambda batch, epoch: sizes.extend(r[1] for r in batch.groupBy(F.spark_partition_id()).count().collect())
    monkeypatch.setattr(stream, "write_bronze_batch", lambda *a, **k: write)
    records = stream.read_events_stream(spark, "parquet", path=files, maxFilesPerTrigger="2")
    stream.start_ingest(records, "raw.none", str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < sum(sizes) / 2
