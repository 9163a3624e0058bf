"""The registered queries of the corpus operators: each runs one over its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from activity_engine.llm import (
    bpe, embedding_whitening, jaccard_join, language_id, lm_scoring, merkle_manifest, pii, quality_rules, suffix_dedup,
    token_orc, toxicity, url_filter, winnowing)
from activity_engine.llm.common import configure, crc_mod
from activity_engine.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_digest(table(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_digest(table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) != 0)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)


def op5_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm", f"tokens-{uuid.uuid4().hex}")
    token_orc.write_tokens(table(spark, sf_dir, "documents"), path,
                           public_tokenizers.path("word_bpe_49k.json"))
    return token_orc.read_digest(spark, path)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_digest(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_digest(table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_digest(table(spark, sf_dir, "documents"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.contamination_digest(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.with_bpe(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text: figures and spans of the fixed forms, and the terms that disclose them."""
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root that a tampered leaf folds to."""
    return merkle_manifest.manifest_digest(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every vector, from exact cross-products of the distinct ones."""
    return embedding_whitening.whiten(table(spark, sf_dir, "embeddings"))


def _configured(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return query(spark, sf_dir)
    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


QUERIES = {q.__name__: _configured(q) for q in (
    op1_url_filter, op2_language_id, op3_quality_rules, op4_toxicity, op5_token_orc,
    op6_suffix_dedup, op7_jaccard_join, op8_lm_scoring, op9_winnowing, op10_bpe,
    op11_pii, op12_merkle_manifest, op13_embedding_whitening)}
