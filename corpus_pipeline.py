"""Corpus pipeline: quality classifier, exact dedup, near dedup, source mixing, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of their input; ``run`` writes each stage's result as Parquet to the shared folder
and reads it back for the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from mixlens.llm import bpe, exact_dedup, mixing, quality, simhash
from mixlens.llm.common import table
from mixlens.llm.queries import tokenizer_path
from mixlens.session import ensure_checkpoint_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling draws; the others go."""
    return quality.keep_sampled(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the packed token ids of each copy."""
    return bpe.encode(docs, tokenizer_path()).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]
ORACLE_SQL = None      # the fitted classifier and the fingerprints have no SQL form; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
