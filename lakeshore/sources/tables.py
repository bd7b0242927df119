"""Tables in the catalog, and incremental reads of a database."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vocabulary import ERP


def table_name(layer: str, table: str) -> str:
    return f"{layer}.{table}"


def read_table(spark: SparkSession, layer: str, table: str, where: dict[str, object] | None = None, missing_ok: bool = False, schema: str | None = None) -> DataFrame:
    """A table of a layer, with equality conditions that prune partitions; empty conditions count as none.

    With missing_ok an absent table reads as an empty one of the given schema.
    """
    name = table_name(layer, table)
    if missing_ok and not spark.catalog.tableExists(name):
        return spark.createDataFrame([], schema or "value string")
    df = spark.table(name)
    for column, value in (where or {}).items():
        if column and value is not None and value != "":
            df = df.where(F.col(column) == F.lit(value))
    return df


def cast_to(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a schema, in its order and types; a boolean becomes 0 or 1 where an int is declared."""
    from pyspark.sql.types import StructType

    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)])


def day_predicates(day: str, columns: tuple[str, ...], parts: int = 1, part_column: str | None = None) -> list[str]:
    """Disjoint conditions for one day of coalesce(columns), as half-open ranges that an index can serve.

    Each column is tried only where those before it are null. With several parts the rows are dealt by a numeric
    column, whose null rows go with the first part.
    """
    first = datetime.date.fromisoformat(day)
    after = first + datetime.timedelta(days=1)
    spans = []
    for k, c in enumerate(columns):
        earlier = "".join(f" AND {b} IS NULL" for b in columns[:k])
        spans.append(f"({c} >= TIMESTAMP('{first} 00:00:00') AND {c} < TIMESTAMP('{after} 00:00:00'){earlier})")
    whole = f"({' OR '.join(spans)})"
    if parts == 1:
        return [whole]
    return [f"{whole} AND (MOD({part_column}, {parts}) = {k}{f' OR {part_column} IS NULL' if k == 0 else ''})" for k in range(parts)]


def read_jdbc(spark: SparkSession, url: str, table: str, where: str | None = None, parts: int = 1, part_column: str | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """A database table, whole or where a condition of the database holds, cast to its declared schema if it has one.

    The condition runs in the database. With several parts the rows are dealt by a numeric column, each part a partition of the read.
    """
    if parts > 1 and not part_column:
        raise ValueError("a read in several parts needs a column to deal the rows by")
    whole = f"({where})" if where else "1 = 1"
    deal = lambda k: f"{whole} AND (MOD({part_column}, {parts}) = {k}{f' OR {part_column} IS NULL' if k == 0 else ''})"
    return _declared(spark.read.jdbc(url, table, predicates=[whole] if parts == 1 else [deal(k) for k in range(parts)], properties=properties or {}), table)


def _declared(df: DataFrame, table: str) -> DataFrame:
    lower = df.toDF(*[c.lower() for c in df.columns])
    declared = ERP.get(table.split(".")[-1].lower())
    return cast_to(lower, declared) if declared else lower


def since_condition(since: datetime.datetime | None, columns: tuple[str, ...]) -> str | None:
    """A condition for rows whose first time of `columns` that isn't null is `since` or later, as ranges that an index can serve; None for all rows."""
    if since is None:
        return None
    at = f"TIMESTAMP('{since:%Y-%m-%d %H:%M:%S.%f}')"
    spans = [f"({c} >= {at}{''.join(f' AND {b} IS NULL' for b in columns[:k])})" for k, c in enumerate(columns)]
    return f"({' OR '.join(spans)})"


def read_jdbc_incremental(spark: SparkSession, url: str, table: str, day: str, date_cols: tuple[str, ...] = ("updated_at", "created_at"), parts: int = 1, part_column: str | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """The rows of a database table that changed on a day (yyyy-MM-dd), cast to its declared schema if it has one.

    The conditions run in the database; each is a partition of the read. Columns are named as the database needs them,
    in quotes where it folds case.
    """
    df = spark.read.jdbc(url, table, predicates=day_predicates(day, date_cols, parts, part_column), properties=properties or {})
    return _declared(df, table)
