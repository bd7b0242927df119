"""Constraints as data-quality operators: count what breaks them, or split it off before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(rule, n_violations) for each named SQL condition, in one pass. A condition that is null isn't violated."""
    counts = df.agg(*[F.sum(F.when(~F.expr(sql), 1).otherwise(0)).cast("long").alias(name) for name, sql in rules.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.coalesce(F.col(n), F.lit(0)).alias("n_violations")) for n in rules]))
    return counts.select(pairs.alias("p")).select("p.*")


def quarantine(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The rows that meet all rules, and the others with _broken, the names of those they break."""
    broken = F.filter(F.array(*[F.when(~F.expr(sql), F.lit(name)) for name, sql in rules.items()]), lambda x: x.isNotNull())
    marked = df.withColumn("_broken", broken)
    return marked.where("size(_broken) = 0").drop("_broken"), marked.where("size(_broken) > 0")


def enforced(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """`df`; an action on it fails at the first row that breaks a rule."""
    for name, sql in rules.items():
        df = df.where(F.when(~F.expr(sql), F.raise_error(F.lit(f"constraint {name} is violated: {sql}")).isNull()).otherwise(True))
    return df
