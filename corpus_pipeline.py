"""A training-data pipeline over `documents`: filters, near-duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages it is written as
Parquet and read again. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import bpe, mixing, near_copies, quality, toxicity
from basketry.llm.common import materialize, read
from basketry.session import delete_copy, temporary_scratch

TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    return toxicity.keep_clean(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a predicted quality label of 1."""
    return quality.keep_good(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a five-word Jaccard of 0.8 the one with the smallest id."""
    return near_copies.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.take(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded bytes of each document taken."""
    return bpe.round_trip(docs, TOKENIZER, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_classifier", drop_poor),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("byte_bpe", tokenize),
]
# The stages learn, hash with XXH64 and draw: tests compare them with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder.

    A stage's own copies, and its input, are deleted as soon as its output is written.
    """
    docs, earlier = read(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        with temporary_scratch(spark):
            docs = materialize(stage(spark, docs, sf_dir), keep=True)
        if earlier is not None:
            delete_copy(earlier)
        earlier = docs
    return STAGES[-1][1](spark, docs, sf_dir)
