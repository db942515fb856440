"""The registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import (
    bpe,
    decontamination,
    filter_audit,
    jaccard,
    licences,
    mixing,
    pii,
    quality_rules,
    sharding,
    substring,
    topk,
    toxicity,
    turn_repair,
)
from lodestrata.sources.tables import load


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(load(spark, sf_dir, "documents"), jaccard.Similarity(3, 90, 100))


def pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(load(spark, sf_dir, "documents"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(load(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.without_repeats(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(load(spark, sf_dir, "documents"))


def exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.valid_vectors(load(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.exact_top_k(vectors.where("id % 50 = 0"), vectors, 5)


def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(load(spark, sf_dir, "documents"))


def toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def filter_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repaired(turn_repair.damaged(load(spark, sf_dir, "conversations")))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digests(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": mix_sources,
    "op2_ngram_jaccard": ngram_jaccard,
    "op3_pii_crf": pii_crf,
    "op4_byte_bpe": byte_bpe,
    "op5_substring_dedup": substring_dedup,
    "op6_kd_shards": kd_shards,
    "op7_licence_scan": licence_scan,
    "op8_toxicity_knn": toxicity_knn,
    "op9_exact_topk": exact_topk,
    "op10_quality_forest": quality_forest,
    "op11_filter_audit": filter_orders,
    "op12_turn_repair": conversation_repair,
    "op13_decontamination": benchmark_leaks,
}
