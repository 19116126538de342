"""Corpus pipeline: stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclebook.llm import decontaminate, pieces, pii, quality, simhash
from cyclebook.llm.shared import for_whole_texts, staged


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that importance resampling rejects."""
    for_whole_texts(spark)
    return quality.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    for_whole_texts(spark)
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item."""
    for_whole_texts(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.benchmark_hits(docs, benchmark)
    return found.filter(F.size("hit_spans") == 0).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind; n_chars follows the text."""
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the SentencePiece ids of the text and the text that they decode to."""
    for_whole_texts(spark)
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_and_decode(docs, model)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", piece_ids),
]

# No stage of models, hashes and token ids can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, every stage applied to what its predecessor kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
