"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (
    ann, bpe, hard_negatives, merkle, mixing, quality, sharding, simhash, token_alignment, token_counts, toxicity,
    url_templates, warc_zip,
)
from basketry.llm.common import read

MULTI_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    return url_templates.judge(read(spark, folder, "pages"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, read(spark, folder, "labels")))
    return scored.withColumn("toxic", (F.col("p_toxic") >= toxicity.THRESHOLD).cast("int"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, folder, "documents"),
                                     token_counts.read_vocabulary(PIECES))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(read(spark, folder, "documents"))


def op5_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.compare_with_edits(read(spark, folder, "documents"))


def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(read(spark, folder, "embeddings"), F.col("id") % 20 == 0)


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(read(spark, folder, "documents"), MULTI_BPE, public_tokenizers.PATTERN)


def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents"))
    return mixed.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"),
                        "target", "taken", "source", "copies")


def op9_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return quality.score(docs, quality.train(docs, read(spark, folder, "labels")))


# labels of every seventh vector move on by one
MOVED_LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding", F.expr(MOVED_LABEL).alias("label"))
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0)


def op12_warc_zip(spark: SparkSession, folder: str) -> DataFrame:
    return warc_zip.round_trip(read(spark, folder, "pages"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.summarize(read(spark, folder, "documents"),
                                     token_alignment.Tokenizers.read(BYTE_BPE, PIECES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_templates, op2_toxicity, op3_token_counts, op4_sharding, op5_document_fingerprints,
        op6_nearest_neighbours, op7_byte_bpe, op8_source_mixing, op9_simhash_dedup, op10_quality,
        op11_hard_negatives, op12_warc_zip, op13_token_alignment)}

ORACLES: dict[str, str] = {
    "op4_sharding": sharding.oracle(),
    "op11_hard_negatives": hard_negatives.oracle("a.vec_id % 100 = 0", MOVED_LABEL),
    "op12_warc_zip": warc_zip.oracle()}
