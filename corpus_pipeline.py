"""From documents to training sequences: reject toxic and poor documents, keep
one of each group of near copies, take out secrets, and pack the rest.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
each result as Parquet below the shared checkpoint folder and reads it again as
the next stage's ``docs``.  All stages but the last keep the columns of
``documents``."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom.llm import jaccard, kneser_ney, packing, secrets, toxicity
from starloom.session import ensure_checkpoint_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: No SQL: toxicity and quality are learnt models.  tests/llm/test_pipeline.py
#: holds the stages against brute force.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.keep_clean(docs, _labels(spark, sf_dir))


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity lies within their language's bounds."""
    return kneser_ney.keep_good(docs, _labels(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id."""
    return jaccard.keep_one_of_each(docs)


def take_out_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secrets.redact_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and place in it."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", reject_toxic),
    ("quality classifier", reject_poor),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", take_out_secrets),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
