"""Distinct users of hourly marts: states that reports merge over any hours and groups, so that who comes twice counts once.

Exact states are bitmaps of user numbers, approximate ones HyperLogLog sketches of a fixed size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Numbers are dealt within so many parts of the users, so that no task numbers all of them.
SHARDS = 1024
#: Logarithm of a sketch's registers; the standard error is 1.04 / sqrt(2 ** LOG_REGISTERS), here 1.6 %.
LOG_REGISTERS = 12
GRAIN = ["app_version", "device_os", "event_type"]


def numbered_users(users: DataFrame, known: DataFrame | None = None, shards: int = SHARDS) -> DataFrame:
    """(user_id, number) of all users, those of `known` as they are: numbers from 1 on, about as dense as users are spread evenly over
    the parts. Null users have no number."""
    seen = users.where("user_id is not null").select("user_id").distinct()
    shard = F.pmod(F.xxhash64("user_id"), F.lit(shards))
    place = F.row_number().over(Window.partitionBy("_shard").orderBy("user_id")).cast("long")
    if known is None:
        return seen.withColumn("_shard", shard).select("user_id", (F.col("_shard") + 1 + (place - 1) * shards).alias("number"))
    new = seen.join(known.select("user_id"), "user_id", "left_anti").withColumn("_shard", shard)
    taken = known.groupBy(shard.alias("_shard")).agg(F.count("*").alias("_taken"))
    added = new.withColumn("_place", place).join(taken, "_shard", "left")
    number = F.col("_shard") + 1 + (F.col("_place") - 1 + F.coalesce("_taken", F.lit(0))) * shards
    return known.select("user_id", "number").unionByName(added.select("user_id", number.alias("number")))


def _hour():
    return F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("hour")


def users_hourly(events: DataFrame, numbers: DataFrame, grain: list[str] = GRAIN) -> DataFrame:
    """(hour, grain, bucket, users): a bitmap of the users of each hour, for every bucket of 32,768 numbers that has any.

    Bits combine before the shuffle. Events without a user are left out. Numbers are joined in shuffled parts, for Spark takes the size of
    events that are kept in a folder from their compressed source, and would broadcast them.
    """
    numbered = events.join(numbers.hint("shuffle_hash"), "user_id")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")
    return numbered.groupBy(_hour(), *grain, F.bitmap_bucket_number("number").alias("bucket")).agg(bits)


def distinct_users(mart: DataFrame, *keys: str) -> DataFrame:
    """(keys, unique_users) of users_hourly(): each user once for each value of the keys, whatever hours these hold."""
    merged = mart.groupBy(*keys, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("users")).alias("n"))
    return merged.groupBy(*keys).agg(F.sum("n").alias("unique_users"))


def sketches_hourly(events: DataFrame, grain: list[str] = GRAIN) -> DataFrame:
    """(hour, grain, users): a sketch of the users of each hour."""
    return events.groupBy(_hour(), *grain).agg(F.hll_sketch_agg("user_id", LOG_REGISTERS).alias("users"))


def estimated_users(mart: DataFrame, *keys: str) -> DataFrame:
    """(keys, unique_users) of sketches_hourly(), within the sketches' error."""
    return mart.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("unique_users"))
