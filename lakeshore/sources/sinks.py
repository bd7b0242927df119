"""Writers of catalog tables, each in one pass over its rows; all return the number of rows that they were given.

A plain Parquet table has no transactions: readers of a partition that is being replaced may see it half done; a table format
with MERGE removes that limit.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import enforced, violations
from ..operators.rows import observed
from ..operators.upsert import repeated_keys, upsert

#: Rules of a table are properties of it, under this prefix.
RULE = "lakeshore.rule."
Values = set[tuple]


def _exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def ensure_database(spark: SparkSession, table: str) -> None:
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rpartition('.')[0]}")


def _text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rules_of(spark: SparkSession, table: str) -> dict[str, str]:
    """The conditions that stay with a table, by name; none for an absent table."""
    if not _exists(spark, table):
        return {}
    return {r["key"].removeprefix(RULE): r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if r["key"].startswith(RULE)}


def add_rules(spark: SparkSession, table: str, conditions: dict[str, str]) -> None:
    """Conditions that every writer of the table obeys from now on. One that a present row breaks raises, and none is added.

    Those that the table has already are neither checked nor changed; a null condition isn't broken.
    """
    present = rules_of(spark, table)
    new = {name: sql for name, sql in conditions.items() if present.get(name) != sql}
    if not new:
        return
    broken = {r["rule"]: r["n_violations"] for r in violations(spark.table(table), new).collect() if r["n_violations"]}
    if broken:
        names = ", ".join(sorted(broken))
        raise ValueError(f"constraint {names} is violated by rows of {table}: {broken}")
    _set_rules(spark, table, new)


def _set_rules(spark: SparkSession, table: str, conditions: dict[str, str]) -> None:
    if conditions:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({', '.join(f'{_text(RULE + k)} = {_text(v)}' for k, v in conditions.items())})")


def drop_rule(spark: SparkSession, table: str, name: str) -> None:
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({_text(RULE + name)})")


#: Number of buckets, and the column that rows are dealt to them by.
Buckets = tuple[int, str]


def _clustered(df: DataFrame, partition_by: list[str] | None, buckets: Buckets | None = None) -> DataFrame:
    """Rows of a partition value together, so that it gets as few files as its size allows: adaptive execution splits large values
    over several tasks and puts small ones into one. Of a bucketed table each bucket is one task's."""
    if buckets:
        return df.repartition(buckets[0], F.col(buckets[1]))
    return df.hint("rebalance", *map(F.col, partition_by)) if partition_by else df


def create_table(df: DataFrame, table: str, partition_by: list[str] | None = None, properties: dict[str, str] | None = None, conditions: dict[str, str] | None = None, buckets: Buckets | None = None) -> int:
    """Make a table anew, with rules that stay with it, and buckets that joins on their column need no exchange of."""
    return _created(df, table, partition_by, properties, conditions, buckets)["n_rows"]


def _created(df: DataFrame, table: str, partition_by: list[str] | None, properties: dict[str, str] | None = None, conditions: dict[str, str] | None = None, buckets: Buckets | None = None, more: tuple[Column, ...] = ()) -> dict:
    ensure_database(df.sparkSession, table)
    rows, seen = observed(_clustered(enforced(df, conditions or {}), partition_by, buckets), None, *more)
    writer = rows.write.format("parquet").mode("overwrite").partitionBy(*(partition_by or [])).options(**(properties or {}))
    (writer.bucketBy(*buckets).sortBy(buckets[1]) if buckets else writer).saveAsTable(table)
    _set_rules(df.sparkSession, table, conditions or {})
    return seen.get


def append_table(df: DataFrame, table: str, partition_by: list[str] | None = None, properties: dict[str, str] | None = None) -> int:
    """Append, or create with partitions and properties; an empty frame creates nothing."""
    return appended(df, table, partition_by, properties)["n_rows"]


def appended(df: DataFrame, table: str, partition_by: list[str] | None = None, properties: dict[str, str] | None = None, *more: Column) -> dict:
    """append_table, that gives `more` aggregates of the written rows beside n_rows; of an empty frame that creates nothing n_rows only."""
    spark = df.sparkSession
    if not _exists(spark, table):
        return {"n_rows": 0} if df.isEmpty() else _created(df, table, partition_by, properties, more=more)
    whole = enforced(df.select(*spark.table(table).columns), rules_of(spark, table))
    rows, seen = observed(_clustered(whole, partition_columns(spark, table), buckets_of(spark, table)), None, *more)
    rows.write.mode("append").insertInto(table)
    return seen.get


def overwrite_table(df: DataFrame, table: str, partition_by: list[str] | None = None, buckets: Buckets | None = None) -> int:
    """Replace the whole table, whose rules stay; the new rows may come from the old ones. If the write fails the old rows are still there.

    The partitions of a table are replaced in place; a table without any is written beside the old one and takes its name. Only
    a change of columns, partitions or buckets writes the rows twice.
    """
    spark = df.sparkSession
    if not _exists(spark, table):
        return create_table(df, table, partition_by, buckets=buckets)
    conditions, there = rules_of(spark, table), spark.table(table)
    same = sorted(df.dtypes) == sorted(there.dtypes) and partition_columns(spark, table) == (partition_by or []) and buckets_of(spark, table) == buckets
    if same and partition_by:
        return overwrite_partitions(enforced(df, conditions), table, _values(there, partition_by))
    stage = f"{table}__stage"
    n = create_table(df.select(*there.columns) if same else df, stage, None, conditions=conditions, buckets=buckets)
    if same:
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {stage} RENAME TO {table}")
    else:
        create_table(spark.table(stage), table, partition_by, conditions=conditions, buckets=buckets)
        spark.sql(f"DROP TABLE {stage}")
    return n


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def buckets_of(spark: SparkSession, table: str) -> Buckets | None:
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    return (int(told["Num Buckets"]), told["Bucket Columns"].strip("[]`")) if told.get("Num Buckets", "").isdigit() else None


def _values(df: DataFrame, columns: list[str]) -> Values:
    """Distinct partition values: as many as there are partitions, which a table's metadata hold, too."""
    return {tuple(r) for r in df.select(*columns).distinct().collect()}


def in_partitions(df: DataFrame, columns: list[str], values: Values) -> DataFrame:
    """The rows of the given partitions. The values of each column prune the scan; where they meet in other partitions, too, a join
    with the values themselves leaves these out."""
    for k, c in enumerate(columns):
        told = {v[k] for v in values}
        among = F.col(c).isin(sorted(told - {None})) if told != {None} else F.lit(False)
        df = df.where(among | F.col(c).isNull() if None in told else among)
    if len(columns) == 1:
        return df
    schema = ", ".join(f"_{c} {dict(df.dtypes)[c]}" for c in columns)
    own = df.sparkSession.createDataFrame(sorted(values, key=repr), schema)
    same = F.struct(*columns).eqNullSafe(F.struct(*[F.col(f"_{c}").alias(c) for c in columns]))
    return df.join(own, same, "left_semi")


def overwrite_partitions(df: DataFrame, table: str, affected: Values) -> int:
    """Make `df` the content of the partitions `affected`; those of them that get no rows are dropped.

    Spark writes beside the partitions and puts them in place at the end, so that `df` may read the table.
    """
    spark, columns = df.sparkSession, partition_columns(df.sparkSession, table)
    seen_values = F.collect_set(F.struct(*columns)).alias("partitions")
    rows, seen = observed(_clustered(df.select(*spark.table(table).columns), columns, buckets_of(spark, table)), None, seen_values)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    got = seen.get
    gone = affected - {tuple(v) for v in got["partitions"] or []}
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(_specs(columns, gone))}")
    return got["n_rows"]


def _specs(columns: list[str], values: Values) -> list[str]:
    return ["PARTITION ({})".format(", ".join(f"{c} = {_literal(x)}" for c, x in zip(columns, v))) for v in sorted(values, key=repr)]


def _literal(v: object) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, (int, float)) else _text(str(v))


def replace_where(df: DataFrame, table: str, column: str, value: object, partition_by: list[str] | None = None) -> int:
    """Make `df` all rows with column = value, or one of a list of values, sub-partitions that vanished included. The first write creates the table."""
    spark, own = df.sparkSession, F.col(column).isin(value) if isinstance(value, list) else F.col(column) == F.lit(value)
    if not _exists(spark, table):
        return create_table(df, table, partition_by or [column])
    affected = _values(spark.table(table).where(own), partition_columns(spark, table))
    return overwrite_partitions(enforced(df.where(own), rules_of(spark, table)), table, affected)


def merge_plan(source: DataFrame, table: str, keys: list[str], update: bool = False, keep: tuple[str, ...] = ()) -> tuple[DataFrame, Values]:
    """The rows after a merge of the partitions that it changes, and these partitions' values.

    Where the keys hold the partition columns these are the source's own; otherwise the target's keys are searched for
    old versions. The scan of whole rows is pruned to them.
    """
    spark = source.sparkSession
    target, columns = spark.table(table), partition_columns(spark, table)
    affected = _values(source, columns)
    if not set(columns) <= set(keys):
        affected |= _values(target.join(source.select(*keys).distinct(), keys, "left_semi"), columns)
    within = in_partitions(target, columns, affected)
    return upsert(within, source, keys, update, keep), affected


def _insert_absent(source: DataFrame, table: str, keys: list[str]) -> None:
    """Append the rows of source whose keys the table lacks: of what is there only keys are read, and nothing is written again.

    Partitions that the catalog doesn't know are entered first, so that files which a broken append has left there are seen.
    """
    spark = source.sparkSession
    columns = partition_columns(spark, table)
    own = _values(source, columns) if columns else set()
    if own:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(_specs(columns, own))}")
    there = spark.table(table)
    there = in_partitions(there, columns, own) if columns and set(columns) <= set(keys) else there
    appended(source.join(there.select(*keys).distinct(), keys, "left_anti"), table)


def merge_table(source: DataFrame, table: str, keys: list[str], partition_by: list[str] | None = None, update: bool = False, keep: tuple[str, ...] = (), rules: dict[str, str] | None = None, buckets: Buckets | None = None) -> int:
    """Upsert into a table, by rewriting only the partitions that old or new versions of the rows are in, or by appending without update; an empty source changes nothing.

    `rules` become the table's, which the source has to obey; `buckets` are those of a table that it makes. The source is made once, and kept on disk while it is read.
    """
    spark, conditions = source.sparkSession, rules or {}
    there = _exists(spark, table)
    if there:
        add_rules(spark, table, conditions)
        conditions = rules_of(spark, table)
    rows = enforced(source, conditions).persist(StorageLevel.DISK_ONLY)
    try:
        n = rows.count()
        if not n:
            return 0
        if update and not repeated_keys(rows, keys).isEmpty():
            raise ValueError(f"several rows of the source have one key of {keys}")
        if not there:
            return create_table(rows, table, partition_by, conditions=conditions, buckets=buckets)
        if not update:
            _insert_absent(rows, table, keys)
            return n
        if not partition_columns(spark, table):
            overwrite_table(upsert(spark.table(table), rows, keys, update, keep), table, buckets=buckets_of(spark, table))
            return n
        merged, affected = merge_plan(rows, table, keys, update, keep)
        overwrite_partitions(merged, table, affected)
        return n
    finally:
        rows.unpersist()


def register_table(spark: SparkSession, table: str, path: str, schema: str, partition_by: list[str] | None = None) -> None:
    """An external table over Parquet files with a declared schema, its partitions found; created anew if it exists."""
    ensure_database(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet{parts} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")
