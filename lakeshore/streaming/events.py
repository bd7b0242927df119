"""Clickstream ingest, alerts and running sales. Transformations are the same for batches and streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.vocabulary import ENVELOPE
from ..sources.sinks import merge_table
from .ledger import append_once

RECORD = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
SALE = "event_type string, user_id string, metadata struct<item: string, is_success: int, units: array<string>, error_message: string>"
TRIGGER = "30 seconds"


def read_events_stream(spark: SparkSession, source: str = "kafka", topic: str = "behavior_events", servers: str = "", path: str = "", **options: str) -> DataFrame:
    """Records of a topic from its beginning: from Kafka, or from files with the same columns.

    Kafka needs Spark's connector on the class path. Lost offsets don't stop the stream.
    """
    if source == "kafka":
        base = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "failOnDataLoss": "false"}
        return spark.readStream.format("kafka").options(**(base | options)).load()
    return spark.readStream.schema(RECORD).options(**options).format(source).load(path)


def _parsed(records: DataFrame, schema: str) -> DataFrame:
    """The records with `e`, their JSON as a struct, parsed once: as a generator's column it isn't copied into each filter on a field."""
    return records.withColumn("e", F.explode(F.array(F.from_json(F.col("value").cast("string"), schema))))


def parse_events(records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Records as raw events: fields of the envelope, metadata as JSON, and where the record came from.

    Unknown fields and null ones aren't in the JSON; a record that isn't JSON has nulls only.
    """
    read = _parsed(records, ENVELOPE)
    # Malformed dates become null rather than an error.
    return read.select(
        "e.event_uuid", "e.event_id", "e.event_type",
        F.col("e.timestamp").alias("event_ts"),
        F.expr("try_cast(e.log_date AS date)").alias("log_date"),
        "e.created_at", "e.session_id", "e.user_id", "e.device_os", "e.app_version",
        F.to_json("e.metadata").alias("raw_metadata"),
        F.col("topic").alias("_kafka_topic"), F.col("partition").alias("_kafka_partition"), F.col("offset").alias("_kafka_offset"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingested_at"),
    )


def write_bronze_batch(table: str, partition_by: str = "log_date", query: str = "ingest", ingested_at: Column | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: parse, and append each batch once, as the table's ledger tells; an empty batch writes nothing, an absent table is made.

    `query` names the stream in the ledger: it has to stay the same over restarts, and to be the stream's own. A stream with a new
    checkpoint counts its batches anew and needs a new name. Events may repeat in different batches, as their producer may send them twice; the conformed layer holds each once.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        append_once(parse_events(batch, ingested_at), epoch, table, query, partition_by)

    return write


def dealt(batch: DataFrame) -> DataFrame:
    """A batch's records over all cores. The few files of a trigger, or partitions of a topic, come in as few tasks with rows (a file is read
    by as many as it has row groups), each of which would parse its share alone."""
    return batch.repartition(batch.sparkSession.sparkContext.defaultParallelism, "partition", "offset")


def start_ingest(records: DataFrame, table: str, checkpoint: str, available_now: bool = False, query: str = "ingest", ingested_at: Column | None = None) -> StreamingQuery:
    write = write_bronze_batch(table, query=query, ingested_at=ingested_at)
    writer = records.writeStream.foreachBatch(lambda batch, epoch: write(dealt(batch), epoch)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER)).start()


def await_any(spark: SparkSession, timeout: int | None = None) -> bool | None:
    return spark.streams.awaitAnyTermination(timeout)


def parse_sales(records: DataFrame) -> DataFrame:
    """Sale events: event_type, user_id, item ('Unknown' if missing), is_success, units (empty if missing), error_message."""
    read = _parsed(records, SALE)
    m = F.col("e.metadata")
    return read.select(
        "e.event_type", "e.user_id", F.coalesce(m["item"], F.lit("Unknown")).alias("item"), m["is_success"].alias("is_success"),
        F.coalesce(m["units"], F.array().cast("array<string>")).alias("units"), m["error_message"].alias("error_message"),
    )


def route_alerts(sales: DataFrame) -> DataFrame:
    """(channel, user_id, message): a text for each sale, a mail for each failed payment, a push for each item seen."""
    sold = (F.col("event_type") == "item_sold") & (F.col("is_success") == 1)
    failed, seen = F.col("event_type") == "payment_failed", F.col("event_type") == "view_item"
    channel = F.when(sold, "sms").when(failed, "email").when(seen, "push")
    units = F.array_join("units", ", ")
    message = F.when(sold, F.concat(F.lit("Confirmed: "), F.col("item"), F.lit(" ["), units, F.lit("]")))
    message = message.when(failed, F.concat(F.lit("Payment failed for "), F.col("item"), F.lit(": "), F.coalesce("error_message", F.lit("Unknown error"))))
    message = message.when(seen, F.concat(F.lit("Offer for "), F.col("item")))
    return sales.select(channel.alias("channel"), "user_id", message.alias("message")).where("channel is not null")


def running_sales(sales: DataFrame, unit_price: int) -> DataFrame:
    """(units_sold, revenue) over all successful sales; on a stream its state is in the checkpoint and survives a restart."""
    sold = sales.where((F.col("event_type") == "item_sold") & (F.col("is_success") == 1))
    units = F.coalesce(F.sum(F.size("units")), F.lit(0)).cast("long")
    return sold.agg(units.alias("units_sold"), (units * unit_price).alias("revenue"))


def sales_by_item(sales: DataFrame, unit_price: int) -> DataFrame:
    """(item, units_sold, revenue) over all successful sales of each item; on a stream one state for each item, in the checkpoint."""
    sold = sales.where((F.col("event_type") == "item_sold") & (F.col("is_success") == 1))
    units = F.sum(F.size("units")).cast("long")
    return sold.groupBy("item").agg(units.alias("units_sold"), (units * unit_price).alias("revenue"))


def start_totals(sales: DataFrame, table: str, checkpoint: str, unit_price: int, available_now: bool = False) -> StreamingQuery:
    """Keep each item's totals in a table: the items whose totals a batch changed are merged by item.

    The totals are states, not increments, so a batch that comes again after a failure writes what it wrote before.
    """
    totals = sales_by_item(sales, unit_price).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = totals.foreachBatch(lambda batch, _: merge_table(batch, table, ["item"], update=True))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER)).start()
