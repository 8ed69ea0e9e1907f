"""A corpus from raw documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtrail.llm import byte_bpe, copies, line_dedup, mixing, near_dedup, quality_classifier
from rowtrail.llm.common import free_name, held, table

MIN_QUALITY = 0.7


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones among them. Without a label nothing is known against any, and all stay."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    if model == quality_classifier.UNKNOWN:
        return docs
    name = free_name(docs, "quality")
    scored = docs.withColumn(name, quality_classifier.score_column(spark, F.col("text"), model))
    return scored.filter(F.col(name) >= MIN_QUALITY).drop(name)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without any line that stands on many sites; near copies count for one site, so copying makes no line wide."""
    return line_dedup.remove_boilerplate(docs, groups=copies.copy_groups(docs))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates on shingles of five words, similarity 0.8 or more."""
    return near_dedup.keep_first(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come in their target shares."""
    return mixing.repeat(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: (doc_id, source, n_tokens, ids)."""
    ids = byte_bpe.encode_column(spark, F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return docs.select("doc_id", "source", ids.alias("ids")).select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_boilerplate),
    ("near dedup", without_near_duplicates),
    ("mixing", mixed),
    ("byte bpe", token_ids),
]

#: The classifier can't be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = held(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
