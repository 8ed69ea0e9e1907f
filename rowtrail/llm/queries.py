"""One query for each operator, over whole tables and whole texts, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from rowtrail.llm import (
    byte_bpe, conversations, fingerprints, hard_negatives, language_id, line_dedup, main_text, mixing, near_dedup, quality_classifier, quality_rules, sharding,
    token_stream)
from rowtrail.llm.common import held, remainder, small_or_shuffled, table
from rowtrail.session import run_folder

SHARDS = 40


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = remainder(F.col("doc_id"), 5)
    known = language_id.dictionaries(documents, rest != 0)
    found = documents.select("doc_id", F.coalesce(rest == 0, F.lit(True)).alias("held_out"), language_id.identify_column(spark, F.col("text"), known).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.best").alias("lang_pred"), "found.score", (F.col("found.lang") == language_id.UNDECIDED).alias("rejected"), "found.margin")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    weights = main_text.learn_weights(pages)
    return pages.select("page_id", "url", main_text.extract_column(spark, F.col("html"), weights).alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_successor(table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = remainder(F.col("doc_id"), 4)
    model = quality_classifier.train(documents, table(spark, sf_dir, "labels"), rest != 2)
    scored = documents.select("doc_id", F.coalesce(rest == 2, F.lit(True)).alias("held_out"), quality_classifier.score_column(spark, F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= corpus_pipeline.MIN_QUALITY).cast("int"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    trusted = held(labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).filter("quality = 1 AND toxic = 0").select("doc_id", F.lit(True).alias("trusted")), "trusted")
    marked = documents.join(small_or_shuffled(trusted), "doc_id", "left")
    ratios = quality_rules.log_ratios(*quality_rules.gram_counts(marked, F.col("trusted")))
    return quality_rules.judge(spark, documents, ratios)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.interleave(table(spark, sf_dir, "documents"), SHARDS)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source", "fraction")


def op11_token_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "token-stream")
    token_stream.write_stream(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return token_stream.document_digests(spark, path)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(conversations.damaged(table(spark, sf_dir, "conversations")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.prepared(table(spark, sf_dir, "embeddings"), moved)
    return hard_negatives.mine(rows, rows.filter("vec_id % 100 = 0"))


#: Links by all pairs that share a shingle; components by walking from each document.
NEAR_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []::VARCHAR[] ELSE list_distinct(list_transform(range(1, greatest(1, len(words) - 3) + 1), lambda i: array_to_string(words[i:i + 3], ' '))) END AS found FROM worded),
single AS MATERIALIZED (SELECT doc_id, md5_number_lower(unnest(found)) AS shingle FROM shingled),
sized AS MATERIALIZED (SELECT doc_id, len(found)::BIGINT AS n FROM shingled),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
walk AS (SELECT doc_id, doc_id AS reached FROM documents UNION SELECT walk.doc_id, edges.b FROM walk JOIN edges ON edges.a = walk.reached),
least AS (SELECT doc_id, min(reached) AS component_id FROM walk GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sized JOIN least USING (doc_id)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language_id, op2_line_dedup, op3_main_text, op4_fingerprints, op5_near_dedup, op6_quality_classifier, op7_mixing, op8_byte_bpe, op9_quality_rules, op10_sharding,
        op11_token_stream, op12_conversation_repair, op13_hard_negatives)
} | {"pipeline": corpus_pipeline.run}
#: Every score of every anchor, ranked.
NEGATIVES_SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS alike, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
ORACLES: dict[str, str] = {"op13_hard_negatives": NEGATIVES_SQL, "op2_line_dedup": line_dedup.SQL, "op5_near_dedup": NEAR_SQL, "op7_mixing": mixing.SQL}
