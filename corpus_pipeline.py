"""From documents to token ids: toxicity, quality, near-duplicates, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again before the next.
Filtering stages learn from the labels of their own input. Near-duplicates: sets of five-word shingles with a similarity of at least 0.8.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from veritrail.llm import bpe, mixing, quality, similar, toxicity
from veritrail.llm.base import MADE, released, stored, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity limit."""
    return toxicity.not_toxic(docs, table(spark, sf_dir, "labels"))


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least the quality limit."""
    return quality.good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return similar.one_of_similar(docs, words=5, least=0.8)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time that words of a document are taken, with those words as its text."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the ids of the text, and digests of ids and decoded bytes."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=("source",), ids=True)


STAGES = [("toxicity", without_toxic), ("quality", of_quality), ("simhash", without_copies), ("mixing", mixed), ("bpe", tokens)]

#: None of the stages is SQL: they learn, hash, draw and tokenize. tests/llm holds them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, since = table(spark, sf_dir, "documents"), len(MADE)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        released(spark, since)
    return STAGES[-1][1](spark, docs, sf_dir)
