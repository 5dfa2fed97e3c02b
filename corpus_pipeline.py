"""Corpus preparation: documents in, packed sequences out, one operator a stage.

Language ID drops what it rejects, exact and near deduplication keep one document of each group,
personal data are replaced in the texts, and what is left is packed. All stages but the last return
the columns of ``documents``; each is written as Parquet and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesforge.llm import exact_dedup, langid, packing, pii, simhash
from seriesforge.session import materialize


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.drop_rejected(docs, langid.fit_on(docs))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_pii(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_dedup_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("PII", pii_stage),
    ("best-fit packing", packing_stage),
]

#: Trained models and fingerprints can't be said in SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
