"""A training-data pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result
is written as Parquet and read again as the next stage's documents.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paneltrend.llm import byte_bpe, exact_dedup, language_id, mixing, simhash_golay
from paneltrend.llm.common import new_folder, ship, table

VOCABULARY = "byte_bpe_50k.tiktoken"


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go; a missing ``lang`` is filled in."""
    ship(spark)
    return language_id.keep_identified(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the one with the largest id stays."""
    ship(spark)
    return exact_dedup.keep_one(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHashes of three-word shingles (3 bits at most) the one with the smallest id stays."""
    ship(spark)
    return simhash_golay.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their temperature weights: every document stays, those of small sources may stand twice."""
    ship(spark)
    return mixing.mix(docs, max_repeats=2.0).select(docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the bytes they decode to."""
    ship(spark)
    ranks = byte_bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return byte_bpe.encode(docs, ranks, decoded=True)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("source_mixing", mixing_stage),
    ("byte_bpe", bpe_stage),
]

#: The language models, the SimHashes and the BPE merges can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
