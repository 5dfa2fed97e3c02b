"""The numbered queries over whole tables and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesforge.llm import (
    conversations, embedding_dedup, exact_dedup, langid, license_scan, merkle, packing, pii, secrets, sentencepiece_viterbi, sharding, simhash, toxicity)
from seriesforge.llm.common import table


def op1_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit_on(docs, table(spark, sf_dir, "labels")))


def op2_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op6_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op7_pii_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit_on(docs))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.round_trip(table(spark, sf_dir, "documents"))


def op10_embedding_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_links(table(spark, sf_dir, "embeddings"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_manifest(table(spark, sf_dir, "documents"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_toxicity_crf": op1_toxicity_crf,
    "op2_bestfit_packing": op2_bestfit_packing,
    "op3_license_scan": op3_license_scan,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_kd_sharding": op5_kd_sharding,
    "op6_simhash_pivots": op6_simhash_pivots,
    "op7_pii_weak": op7_pii_weak,
    "op8_langid": op8_langid,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_embedding_passes": op10_embedding_passes,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_secret_scan": op12_secret_scan,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES = {
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op13_conversation_repair": conversations.ORACLE,
}
