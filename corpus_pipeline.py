"""A training-data pipeline: five stages over `documents`, each written as Parquet and reread.

Language identification and the quality classifier drop the documents that they reject, SimHash
near-dedup leaves one document of each group, decontamination drops those that hold a benchmark
item, and the rest are encoded. Every stage works on all that the one before it kept, copes with
null and empty texts, repeated rows, empty tables and extra columns as its operator says, and all
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, cotraining, languages, shingles, templates
from tessera.session import materialise

#: Most of the stages are models or tokenizers, which SQL cannot express; tests hold each stage
#: against a brute-force version instead.
ORACLE_SQL = None
VOCABULARY = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in some language; those that are `und` go."""
    return languages.accepted(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier, fitted on `labels`, keeps."""
    return cotraining.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first by identifier, of each group of near copies."""
    return shingles.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of `benchmark`."""
    return templates.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifier, number of ids, and digests of ids and of decoded text of each document."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path(VOCABULARY), outputs=("digests",))


STAGES = [
    ("language_id", language_id),
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
