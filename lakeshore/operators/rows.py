"""Latest rows and first rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order, which has to be total for a certain result. Null keys are one key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def observed(df: DataFrame, name: str | None = None, *more: Column) -> tuple[DataFrame, object]:
    """The frame, and an Observation that holds its row count, and `more` aggregates, once an action over all of it has run; no second pass."""
    from pyspark.sql import Observation

    seen = Observation(name) if name else Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *more), seen
