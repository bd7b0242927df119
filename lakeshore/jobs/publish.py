"""Tables for analysts: external tables of another database over the files of dashboard tables, with the schema that is declared then."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sources.sinks import partition_columns, register_table


def location(spark: SparkSession, table: str) -> str:
    """The folder of a table's files."""
    return next(r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect() if r["col_name"] == "Location")


def publish(spark: SparkSession, tables: list[str], source: str = "gold", database: str = "analytics") -> list[str]:
    """Register tables of a layer that exist in a database of their own, partitions found anew; the names of those that were registered.

    To run after the day's jobs: a published table lists the partitions that there were then. No row is copied.
    """
    done = []
    for name in tables:
        table = f"{source}.{name}"
        if spark.catalog.tableExists(table):
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(table).schema)
            register_table(spark, f"{database}.{name}", location(spark, table), schema, partition_columns(spark, table))
            done.append(f"{database}.{name}")
    return done
