"""Corpus pipeline: toxic documents go, one of each near-duplicate group stays, long
repeats are cut out, contaminated documents go, the rest is encoded.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; each one's result is
written as Parquet and read again as the next one's documents. All but the last
return the columns of ``documents``. A text that loses repeats keeps its row with
the text that is left (n_chars follows; a null text stays null).
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_engine.llm import bpe, jaccard_join, suffix_dedup, toxicity, winnowing
from activity_engine.llm.common import configure, crc_mod, fresh_name
from activity_engine.session import scratch_path

#: Words of the least passage that may not repeat across documents, however few bytes it has.
PASSAGE_WORDS = 51


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents scored 0.5 or more go."""
    configure(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = fresh_name(docs.columns, "_toxicity")
    scored = toxicity.with_toxicity(docs, labels, crc_mod("doc_id", 5) != 0, out=score)
    return scored.filter(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the least doc_id of each group of linked documents stays."""
    configure(spark)
    return jaccard_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: bytes covered by a repeated 400-byte string, or by over 50 repeated words, go."""
    configure(spark)
    removal = fresh_name(docs.columns, "_removal")
    left = F.when(F.col("text").isNotNull(), F.col(removal)["kept_text"])
    cut = suffix_dedup.remove_repeats(docs, words=PASSAGE_WORDS, out=removal).withColumn("text", left)
    return cut.withColumn("n_chars", F.length("text").cast("long")).drop(removal)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that share ten words in a row with a test item go."""
    configure(spark)
    return winnowing.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: token counts and digests of ids and decoded text."""
    configure(spark)
    return bpe.with_bpe(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: SQL cannot express the stages; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, "llm", f"stage-{number}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
