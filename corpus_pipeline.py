"""A corpus pipeline: toxicity, line dedup, near-dedup, decontamination, tokens. Each stage is written and read again.

Texts of any length are worked on whole. Extra columns of any name pass through all stages but the last. Empty tables give empty
ones.
"""

from __future__ import annotations

import public_tokenizers
from lakeshore.llm import decontaminate, lines, sentencepieces, simhash, toxicity
from lakeshore.llm.common import dropped, fresh_path, table
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a factorization machine, fitted to the labelled ones among them, doesn't find toxic.

    Null and empty texts and null ids are no reason to go; of repeated rows all stay or go.
    """
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def remove_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand on many sites; n_chars follows the text where lines went.

    Null and empty texts stay as they are. Of documents that share a line the one with the smallest id keeps it; rows of one id
    are one document, null ids one that comes last.
    """
    cut = lines.remove_boilerplate(docs)
    n_chars = F.when(F.col("_n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts: the one with the smallest id.

    Rows of one id stay or go together, rows with a null id stay; null, empty and blank texts are copies of one another.
    """
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Rows with a null id or without a text stay, rows of one id stay or go together; an empty benchmark drops none.
    """
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and of the decoded text, for each document.

    A null text has the tokens of an empty one; null and repeated ids pass through.
    """
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepieces.digests(sentencepieces.encode_decode(docs, model))


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", remove_boilerplate_lines),
    ("SimHash near-dedup", keep_one_of_similar),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("SentencePiece", tokenize),
]

#: SQL can express neither the learned scores nor SimHash; tests/llm compares the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; what a stage wrote is deleted once the next one has been written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, name.lower().replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            dropped(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
