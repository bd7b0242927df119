"""Exact duplicates by progressive refinement: equal lengths, then equal prefixes, then equal full hashes. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, dealt_anew, dropped, free_name, fresh_path, lowered

#: So many characters make the prefix.
PREFIX = 256


def normalised(text: Column) -> Column:
    """What texts are compared by: A-Z in lower case; null is the empty text."""
    return lowered(F.coalesce(text, F.lit("")))


def _length(text: Column) -> Column:
    """Bytes of the normalised text, which are those of the text."""
    return F.coalesce(F.octet_length(text), F.lit(0))


def _table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows written and read again: as a table their size is known, so that Spark sends them to all tasks if they are few, and
    joins by a shuffle otherwise. The caller deletes the folder, which comes second."""
    df.write.parquet(path := fresh_path(df.sparkSession, name))
    return df.sparkSession.read.parquet(path), path


def shared_prefixes(docs: DataFrame, text_col: str = "text", prefix: int = PREFIX) -> DataFrame:
    """(_length, _prefix): the lengths and the hashes of the first `prefix` characters that several texts have in common.

    Prefixes are hashed only of texts whose length another one has. Counts combine before the shuffle, so that
    neither a length nor a prefix of many texts meets in one task. Null texts are empty ones; repeated rows are equal texts;
    an empty table gives no rows.
    """
    text, several = F.col(text_col), F.count(F.lit(1)).alias("_n")
    sized = docs.select(_length(text).alias("_length"), F.left(text, F.lit(prefix)).alias("_head"))
    lengths, path = _table(sized.groupBy("_length").agg(several).where("_n > 1").select("_length"), "shared-lengths")
    heads = sized.join(lengths, "_length", "left_semi").select("_length", F.xxhash64(normalised(F.col("_head"))).alias("_prefix"))
    shared = checkpointed(heads.groupBy("_length", "_prefix").agg(several).where("_n > 1").select("_length", "_prefix"))
    dropped(docs.sparkSession, path)
    return shared


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX, carry: tuple[str, ...] = (), digests: bool = False) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row, and the columns of `carry` as they are.

    Texts are equal if they are identical after lower-casing A-Z only; null is empty. Of equal texts the row with the largest
    id stays; keep_id is its id, null only if no row of the group has one. Of rows that repeat the id, too, any one stays. Full texts are hashed only
    where length and prefix are those of another row; text_sha256 of other rows is null, unless `digests` asks for every
    row's. Long texts are hashed whole; an empty table gives no rows.
    """
    text = F.col(text_col)
    own = {n: free_name(docs, n) for n in ("_length", "_prefix", "_several")}
    shared, path = _table(shared_prefixes(docs, text_col, prefix), "shared-prefixes")
    shared = shared.select(F.col("_length").alias(own["_length"]), F.col("_prefix").alias(own["_prefix"]), F.lit(True).alias(own["_several"]))
    keyed = docs.withColumns({own["_length"]: _length(text), own["_prefix"]: F.xxhash64(normalised(F.left(text, F.lit(prefix))))})
    met = keyed.join(shared, [own["_length"], own["_prefix"]], "left")
    digest = F.sha2(normalised(text), 256)
    full = F.when(F.col(own["_several"]), digest)
    rows = checkpointed(
        met.select(
            F.col(id_col).cast("long").alias("_id"), F.struct(*carry).alias("_carried") if carry else F.lit(None).cast("int").alias("_carried"),
            full.alias("_full"), (F.coalesce(full, digest) if digests else full).alias("_digest"), F.monotonically_increasing_id().alias("_row"),
        )
    )
    dropped(docs.sparkSession, path)
    best = F.max(F.struct("_id", "_row")).alias("_best")
    equal = rows.where("_full is not null").groupBy("_full").agg(best, F.count(F.lit(1)).alias("_size"))
    met = rows.where("_full is not null").join(dealt_anew(equal, "_full"), "_full")

    def told(df: DataFrame, keep: Column, size: Column, stays: Column) -> DataFrame:
        named = df.select(F.col("_id").alias("doc_id"), keep.alias("keep_id"), size.cast("long").alias("group_size"), stays.alias("kept"), F.col("_digest").alias("text_sha256"), "_carried")
        return named.select("*", "_carried.*").drop("_carried") if carry else named.drop("_carried")

    # Texts that nothing equals are in no join: they have no hash to meet by.
    alone = told(rows.where("_full is null"), F.col("_id"), F.lit(1), F.lit(True))
    return told(met, F.col("_best._id"), F.col("_size"), F.col("_best._row") == F.col("_row")).union(alone)


def remove_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX) -> DataFrame:
    """The rows of `docs` that stay, with all of their columns, whatever these are called. See groups() for nulls and ties."""
    whole = docs.withColumn(kept := free_name(docs, "_whole"), F.struct(*docs.columns))
    found = groups(whole, id_col, text_col, prefix, carry=(kept,))
    return found.where("kept").select(f"{kept}.*")
