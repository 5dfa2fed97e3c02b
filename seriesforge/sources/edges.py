"""The last reading of every (key, time bucket) of a table, kept current by its upserts.

Incremental features need to know which non-empty buckets come before and after those a batch falls
into. Asked from the readings that is a scan of all history of the batch's series; here it is one row a
bucket, in days like the table itself, of which a batch reads those around its own times.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from seriesforge.config import SeriesSpec
from seriesforge.functions import times
from seriesforge.operators.buckets import BUCKET, bucket_of, measured
from seriesforge.session import materialize, settle

_RANK = StructType([StructField("us", LongType()), StructField("seq", LongType())])
_STORED = StructType([StructField("key", StringType()), StructField("at", TimestampNTZType()),
                      StructField("v", DoubleType()), StructField("rank", _RANK)])
_SPEC = SeriesSpec(key="key", ts="at", value="v", seq="rank")


class EdgeTable:
    """One row a (key, bucket): the reading that keep-last puts last. ``rank`` (time, seq) decides, so replays are harmless."""

    def __init__(self, table, width_us: int):
        self.table, self.width_us = table, width_us
        self.stored = type(table)(table.spark, f"{table.path}/edges/{width_us}", _STORED, _SPEC)

    def create(self) -> EdgeTable:
        """Fill it from the readings once; from then on every upsert of the table adds to it."""
        if not self.stored.exists():
            self.stored.create()
            self.add(self.table.scan())
        return self

    def add(self, rows: DataFrame) -> None:
        spec = self.table.spec
        us = times.micros(spec.ts)
        start = times.from_micros(bucket_of(us, self.width_us) * F.lit(self.width_us))
        last = F.struct(us.alias("us"), F.col(spec.seq).cast("long").alias("seq"), measured(spec).alias("v"))
        edges = rows.dropna(subset=[spec.key, spec.ts]).groupBy(F.col(spec.key).alias("key"), start.alias("at")).agg(F.max(last).alias("e"))
        self.stored.upsert(edges.select("key", "at", "e.v", F.struct("e.us", "e.seq").alias("rank")))

    def around(self, hits: DataFrame) -> DataFrame:
        """(key, bucket, _prev, _prev_bucket) of the stored buckets in and around ``hits`` (key, bucket).

        The days read reach from before the first hit to behind the last, and further only while a hit
        bucket has a neighbour that may lie beyond: after a long silence, or for the first of a series.
        """
        spec = self.table.spec
        hits = settle(hits, "hit-buckets")
        ends = hits.agg(F.min(BUCKET), F.max(BUCKET)).first()
        if ends[0] is None:
            ends = (0, 0)
        keys = hits.select(spec.key).distinct()
        known, reach = self.stored.days(), 2
        while True:
            first, last = (self._day(b) for b in (ends[0] - reach, ends[1] + reach))
            near = self.stored.scan_days(first, last).withColumnRenamed("key", spec.key).join(keys, spec.key, "left_semi")
            order = Window.partitionBy(spec.key).orderBy(BUCKET)
            edge = F.struct(F.col("rank.us").alias("us"), F.col("rank.seq").alias("seq"), "v")
            found = materialize(near.withColumn(BUCKET, bucket_of(times.micros("at"), self.width_us)).select(
                spec.key, BUCKET, F.lag(edge).over(order).alias("_prev"), F.lag(BUCKET).over(order).alias("_prev_bucket"),
                F.lead(BUCKET).over(order).alias("_next_bucket")), "edges")
            beyond = F.lit(False)
            if known and known[0] < first:
                beyond = beyond | F.col("_prev_bucket").isNull()
            if known and known[-1] > last:
                beyond = beyond | F.col("_next_bucket").isNull()
            if found.join(hits, [spec.key, BUCKET], "left_semi").filter(beyond).isEmpty():
                return found.drop("_next_bucket")
            reach *= 8

    def _day(self, bucket: int) -> str:
        return str((datetime(1970, 1, 1) + timedelta(microseconds=bucket * self.width_us)).date())


def edge_tables(table) -> list[EdgeTable]:
    """The edge tables there are of a table."""
    return [EdgeTable(table, int(name)) for name in table.folders("edges") if name.isdigit()]
