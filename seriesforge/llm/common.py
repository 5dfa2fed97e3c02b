"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesforge.session import materialize, settle

#: ASCII white space, as the operators' contracts spell it.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def documents(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty), whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def gapless(df: DataFrame, group: str, order: list[str], name: str, rows_per_task: int = 20_000) -> DataFrame:
    """Number the rows of each group from 0 without holding a group in one task.

    A group is cut into buckets by a hash of ``order``; rows are numbered within a bucket, which
    then starts where the smaller buckets of its group end. ``df`` must be cheap to read twice,
    and rows that agree in all of ``order`` may swap numbers among themselves.
    """
    largest = df.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    buckets = -(-largest // rows_per_task) or 1
    cut = df.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = cut.groupBy(group, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(sizes.select(group, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")), "starts")
    within = F.row_number().over(Window.partitionBy(group, "__b").orderBy(*order))
    return (
        cut.withColumn("__r", within)
        .join(starts, [group, "__b"])
        .withColumn(name, (F.col("__start") + F.col("__r") - 1).cast("long"))
        .drop("__b", "__r", "__start")
    )


__all__ = ["SPACE", "documents", "gapless", "materialize", "remainder", "settle", "slices", "table", "text_of", "worker_cache"]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: what a step makes of them stays small beside the batch itself."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker: what a task loads, the next one finds.

    Worker code travels by value, so module globals start anew with each task.
    """
    import sys
    import types

    return sys.modules.setdefault("_seriesforge_worker_cache", types.ModuleType("_seriesforge_worker_cache")).__dict__
