"""Line dedup: lines that stand on many distinct sites are boilerplate. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, free_name, two_hashes

MIN_SITES = 10
#: Estimates within this share of the threshold are replaced by exact counts; over ten standard errors at LG_K.
BAND, LG_K = 0.2, 12


def _line(x: Column) -> Column:
    return F.btrim(x, F.lit(" \t\r\x0b\x0c"))


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    every = docs.select(F.col(id_col).alias("id"), F.col(site_col).cast("string").alias("site"), F.explode(F.split(text_col, "\n")).alias("line"))
    trimmed = every.select("id", "site", _line(F.col("line")).alias("line")).where("line <> ''")
    return trimmed.select("id", "site", two_hashes(F.col("line")).alias("h"))


def boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """(h, first_id, n_sites) of the lines on min_sites distinct sites at least; n_sites is null where the sketch was clear enough.

    One HyperLogLog sketch for each line hash: partial sketches are made before the shuffle and merged after it, so
    that a line of a third of all rows costs each task one sketch. Lines whose estimate is near the threshold get an
    exact distinct count. A null site counts as none; blank lines are never boilerplate.
    """
    lines = _lines(docs, id_col, text_col, site_col)
    sketched = lines.groupBy("h").agg(F.hll_sketch_agg("site", LG_K).alias("sketch"), F.min("id").alias("first_id"))
    told = sketched.select("h", "first_id", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("about"))
    # Few rows, written once: joins with them can then be dealt anew where a line is on many rows.
    told = checkpointed(told.where(F.col("about") >= min_sites * (1 - BAND)))
    near = F.col("about") <= min_sites * (1 + BAND)
    sites = lines.join(told.where(near).select("h"), "h").where("site is not null").select("h.a", "h.b", "site").distinct()
    exact = sites.groupBy("a", "b").agg(F.count("*").alias("n_sites")).where(F.col("n_sites") >= min_sites)
    checked = told.where(near).join(exact.select(F.struct("a", "b").alias("h"), "n_sites"), "h").select("h", "first_id", "n_sites")
    return told.where(~near).select("h", "first_id", F.lit(None).cast("long").alias("n_sites")).unionByName(checked)


def remove_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """`docs` without its boilerplate lines, except in the document with the smallest id that has the line; and _n_removed, their number.

    Null texts stay null with 0; a text of which all lines go is empty, one of any length is worked on whole. Rows with one id are one document: what goes is
    decided for the id, then cut from each of its rows. Null ids are one id, larger than all others. A column that is
    called _n_removed already is replaced.
    """
    base = docs.drop("_n_removed")
    id_, gone_ = free_name(base, "_id"), free_name(base, "_gone")
    found = boilerplate(docs, id_col, text_col, site_col, min_sites).select("h", "first_id")
    hits = _lines(docs, id_col, text_col, site_col).select("id", "h").join(found, "h").where(~F.col("id").eqNullSafe(F.col("first_id")))
    gone = hits.groupBy(F.col("id").alias(id_)).agg(F.collect_set("h").alias(gone_))
    joined = base.join(gone, F.col(id_col).eqNullSafe(F.col(id_)), "left")
    lines = F.split(text_col, "\n")
    left = F.filter(lines, lambda x: (_line(x) == "") | ~F.array_contains(F.col(gone_), two_hashes(_line(x))))
    removed = F.when(F.col(gone_).isNull() | F.col(text_col).isNull(), 0).otherwise(F.size(lines) - F.size(left))
    text = F.when(F.col(gone_).isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    return joined.select(*[text.alias(c) if c == text_col else base[c] for c in base.columns], removed.alias("_n_removed"))
