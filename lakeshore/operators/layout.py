"""File layout: compaction and clustering along a space-filling curve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compact(df: DataFrame, input_bytes: int, target_bytes: int = 128 << 20, partition_by: list[str] | None = None) -> DataFrame:
    """Rows in as many files as input_bytes need at target_bytes each; with partition columns their rows come together.

    A partition value of more rows than a file's share is dealt over several files.
    """
    n = max(1, -(-input_bytes // target_bytes))
    if not partition_by:
        return df.repartition(n)
    spread = F.pmod(F.xxhash64(*[c for c in df.columns if c not in partition_by] or partition_by), F.lit(n)).cast("int")
    return df.withColumn("_deal", spread).repartition(n, *partition_by, "_deal").drop("_deal")


def ranks(df: DataFrame, col: str, bits: int) -> Column:
    """The equal-count bucket of a value among 2**bits, from approximate quantiles: a column over df. Nulls are bucket 0."""
    shares = [k / 2**bits for k in range(1, 2**bits)]
    cuts = df.select(F.percentile_approx(F.col(col), shares, 10 * 2**bits)).first()[0] or []
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(col))), F.lit(0)) if cuts else F.lit(0)


def interleaved(parts: list[Column], bits: int) -> Column:
    """Morton order: bit b of part p is bit b * len(parts) + p."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for p, part in enumerate(parts):
            bit = F.shiftright(part.cast("long"), b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(parts) + p))
    return out


def zorder(df: DataFrame, cols: list[str], n: int, bits: int = 6) -> DataFrame:
    """Rows in n files such that each holds a small range of every column in cols, so that filters on any of them skip files.

    At most 2**bits quantiles of each column come to the driver.
    """
    z = interleaved([ranks(df, c, bits) for c in cols], bits)
    return df.withColumn("_z", z).repartitionByRange(n, "_z").sortWithinPartitions("_z").drop("_z")
