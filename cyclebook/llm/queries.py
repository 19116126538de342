"""One query for each numbered operator, over its whole table, and SQL where it can express one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclebook.llm import decontaminate, embeddings, language, merkle, pieces, pii, quality, simhash, suffixes
from cyclebook.llm import token_output, toxicity, trie, warc
from cyclebook.llm import oracle as Q

TOKENS = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf, "documents"))


def warc_bundles(spark: SparkSession, sf: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(_table(spark, sf, "pages")))


def benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents").select("doc_id", "text")
    return decontaminate.hit_digest(
        decontaminate.benchmark_hits(documents, _table(spark, sf, "benchmark")).drop("text"))


def simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.passage_digest(_table(spark, sf, "documents"))


def toxicity_scores(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf, "embeddings"))


def sentencepiece_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.round_trip(_table(spark, sf, "documents"), public_tokenizers.path(PIECES))


def token_id_output(spark: SparkSession, sf: str) -> DataFrame:
    manifest = token_output.write_tokens(_table(spark, sf, "documents"), public_tokenizers.path(TOKENS))
    return token_output.read_tokens(manifest)


def quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality.sample_keys(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, sf, "conversations"))


def language_model_scores(spark: SparkSession, sf: str) -> DataFrame:
    return language.score(language.fit(language.learned(_table(spark, sf, "documents"))))


def merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    return merkle.proofs(merkle.manifest(documents, changed=merkle.tampered_digest(documents)))


QUERIES: dict[str, tuple] = {
    "op1_personal_data": (personal_data, None),
    "op2_warc_bundles": (warc_bundles, Q.WARC),
    "op3_benchmark_decontamination": (benchmark_decontamination, Q.DECONTAMINATION),
    "op4_simhash_near_dedup": (simhash_near_dedup, None),
    "op5_suffix_array_dedup": (suffix_array_dedup, None),
    "op6_toxicity": (toxicity_scores, None),
    "op7_embedding_near_dedup": (embedding_near_dedup, Q.EMBEDDINGS),
    "op8_sentencepiece": (sentencepiece_round_trip, None),
    "op9_token_id_output": (token_id_output, None),
    "op10_quality_classifier": (quality_classifier, None),
    "op11_conversation_trie": (conversation_trie, Q.TRIE),
    "op12_language_model": (language_model_scores, None),
    "op13_merkle_manifest": (merkle_manifest, Q.MERKLE),
}
