"""Upserts, slowly changing dimensions and change feeds as joins: pure functions of the old and the new rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """target with the rows of source merged in by keys, as source's columns are named in target.

    Without update matched rows stay as they are; with it they take source's values except in the columns `keep`.
    A null key matches nothing, so its row is inserted. Source rows with one key are all kept, and with `keep` each of them
    once for every target row of the key; repeated_keys() finds them, and merge_table raises on them.
    """
    source = source.select(*target.columns)
    if not update:
        return target.unionByName(source.join(target.select(*keys).distinct(), keys, "left_anti"))
    if keep:
        old = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in keep], F.lit(True).alias("_matched"))
        joined = source.join(old, keys, "left")
        source = joined.select(*[F.when(F.col("_matched"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) if c in keep else F.col(c) for c in target.columns])
    return target.join(source.select(*keys).distinct(), keys, "left_anti").unionByName(source)


def repeated_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys without a null that several source rows have; an update needs this to be empty."""
    whole = source.na.drop(subset=keys)
    return whole.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def scd2_merge(target: DataFrame, source: DataFrame, key: str, version: str = "updated_at") -> DataFrame:
    """History with validity: target has source's columns, is_current, valid_from and valid_to.

    A current row older than source's row of its key is closed at that row's version. Source rows whose key has no
    current row left are appended as current ones; rows that aren't newer change nothing.
    """
    new = source.select(F.col(key), F.col(version).alias("_at"))
    joined = target.join(new, key, "left")
    closes = F.col("is_current") & F.coalesce(F.col(version) < F.col("_at"), F.lit(False))
    closed = joined.withColumn("valid_to", F.when(closes, F.col("_at")).otherwise(F.col("valid_to"))).withColumn("is_current", F.col("is_current") & ~closes).drop("_at")
    added = source.join(closed.where("is_current").select(key), key, "left_anti")
    added = added.select("*", F.lit(True).alias("is_current"), F.col(version).alias("valid_from"), F.lit(None).cast(target.schema["valid_to"].dataType).alias("valid_to"))
    return closed.select(*target.columns).unionByName(added.select(*target.columns))


def change_feed(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """What changed between two states of a table with unique keys: its columns and _change, as insert, update_preimage,
    update_postimage or delete."""
    values = [c for c in new.columns if c not in keys]
    row = F.struct(*new.columns)
    a, b = old.select(*keys, row.alias("_old")), new.select(*keys, row.alias("_new"))
    same = [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in values]
    changed = F.lit(False)
    for x in same:
        changed = changed | ~x
    joined = a.join(b, keys, "full").where(F.col("_old").isNull() | F.col("_new").isNull() | changed)
    one = lambda kind, side: F.struct(F.lit(kind).alias("kind"), F.col(side).alias("row"))
    kinds = F.when(F.col("_old").isNull(), F.array(one("insert", "_new"))).when(F.col("_new").isNull(), F.array(one("delete", "_old")))
    kinds = kinds.otherwise(F.array(one("update_preimage", "_old"), one("update_postimage", "_new")))
    return joined.select(F.explode(kinds).alias("c")).select("c.row.*", F.col("c.kind").alias("_change"))
