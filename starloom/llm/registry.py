"""One query for each operator of this package, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom.llm import (bpe, imatch, jaccard, kneser_ney, license_scan, merkle, oracle, packing, periods, projections, secrets, substrings,
                          token_counts, toxicity)

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(_docs(spark, sf_dir), WORD_BPE)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_docs(spark, sf_dir))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_docs(spark, sf_dir))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_docs(spark, sf_dir), WORD_BPE)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_docs(spark, sf_dir), BYTE_BPE)


def op6_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(_docs(spark, sf_dir))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_docs(spark, sf_dir))


def op9_collision_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_docs(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.run_digests(_docs(spark, sf_dir))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeat_digests(_docs(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_bpe_round_trip, op2_ngram_jaccard, op3_license_scan, op4_best_fit_packing, op5_token_counts,
             op6_kneser_ney_quality, op7_imatch_fingerprints, op8_secret_scan, op9_collision_projections, op10_toxicity,
             op11_merkle_manifest, op12_periodic_runs, op13_substring_dedup)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where it can express the operator in bearable time; tests/llm
    holds the others against brute force."""
    return {"op2_ngram_jaccard": oracle.JACCARD, "op9_collision_projections": oracle.COLLISIONS, "op11_merkle_manifest": oracle.MERKLE,
            "op12_periodic_runs": oracle.PERIODS, "op13_substring_dedup": oracle.SUBSTRINGS}
